"""Job plans: compositions of operators, sources and sinks."""
