"""Services with protocols of their own: sinks that send rows by batches, sources that fetch by parts."""

from weftline.sources.services import analytics, aws, messages, search, sockets  # noqa: F401  they enter themselves
from weftline.sources.services.core import READ, WRITTEN, read, settle, write

__all__ = ["READ", "WRITTEN", "read", "settle", "write"]
