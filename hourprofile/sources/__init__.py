from .files import read_csv, read_lines, stream_csv, stream_json_messages  # noqa: F401
from .jdbc import read_jdbc  # noqa: F401
from .kafka import read_kafka, stream_kafka  # noqa: F401
