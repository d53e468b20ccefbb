"""DataFrame -> DataFrame operators of the order-event platform."""
