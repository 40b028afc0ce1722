"""Inputs: Kafka or file text (S1), change feeds (S2), JDBC (S3, S5), the ``topic_db`` view (S4), and
wire-format records built from warehouse tables (for tests, benches and the oracle queries)."""
