"""Query plans composed from the operators, as registered with the driver."""
