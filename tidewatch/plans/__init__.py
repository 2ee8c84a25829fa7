"""Jobs composed of operators, with their reads and writes."""
