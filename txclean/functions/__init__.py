"""Column functions: text in, text or timestamps out, no Python in the row path."""

from txclean.functions.text import pg_initcap, segment_keys, shifted_segment_keys
from txclean.functions.timestamps import parse_mixed_timestamp

__all__ = ["parse_mixed_timestamp", "pg_initcap", "segment_keys", "shifted_segment_keys"]
