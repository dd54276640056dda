"""DataFrame to DataFrame operators that the reports are made of."""
