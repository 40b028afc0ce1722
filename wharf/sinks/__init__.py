"""Outputs: routed Kafka/file/console sinks (K1, K2, K10) and the dimension store (K3-K9)."""
