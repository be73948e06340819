"""Readers: CSV records (S1), web access log (S2), queue payloads (S3), and the
derivation of the reference's record streams from the driver's tables."""

from .access_log import parse_access_log, read_access_log, read_access_log_stream
from .records import decode_records, read_queue_stream, read_records, read_records_stream, records_from_lines

__all__ = ["parse_access_log", "read_access_log", "read_access_log_stream", "decode_records",
           "read_queue_stream", "read_records", "read_records_stream", "records_from_lines"]
