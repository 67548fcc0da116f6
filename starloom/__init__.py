"""starloom: Spark-native operators for building and rolling up a catalogue star schema."""

__version__ = "0.1.0"
