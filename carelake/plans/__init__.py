"""Models built from operators: staging, marts, gold, knowledge."""
