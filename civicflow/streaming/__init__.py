from .tickets_stream import clean_stream, read_raw_stream, write_clean_stream  # noqa: F401
