"""Spark-native event-sequence and waveform analytics."""
