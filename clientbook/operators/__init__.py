"""DataFrame-in, DataFrame-out operators of the portfolio model."""
