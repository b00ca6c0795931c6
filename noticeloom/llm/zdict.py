"""Zstandard raw-content dictionaries as classifiers: how many bytes a piece of text costs given each of them."""

from __future__ import annotations

from collections.abc import Iterator

LEVEL = 3


def compressor(content: bytes, level: int = LEVEL):
    """A compressor primed with ``content``; frames carry neither size, checksum nor dictionary id."""
    import zstandard

    if not content:
        return zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False, write_dict_id=False)
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def windows(raw: bytes, size: int) -> Iterator[bytes]:
    """The whole text in pieces of about ``size`` bytes, cut after a blank where one is near; none is left out."""
    at, n = 0, len(raw)
    while at < n:
        end = at + size
        if end < n:
            blank = raw.rfind(b" ", at + size // 2, end)
            end = blank + 1 if blank > 0 else end
        else:
            end = n
        yield raw[at:end]
        at = end
