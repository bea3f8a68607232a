"""Software-delivery metrics as DataFrame operators on Spark."""
