"""Where listings, object bodies and tables come from and go to."""
