"""DataFrame → DataFrame operators. None of them collects data to the driver."""
