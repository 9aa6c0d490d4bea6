from .delimited import load_csv, split_corrupt  # noqa: F401
from .messages import publish_events, read_event_stream  # noqa: F401
from .realtime import append_batch, create_realtime_tables, direct_append, read_realtime  # noqa: F401
from .tables import Lake  # noqa: F401
