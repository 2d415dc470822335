"""DataFrame -> DataFrame operators, one per step of the customer export."""
