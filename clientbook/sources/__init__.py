"""Reading inputs into the declared frames."""
