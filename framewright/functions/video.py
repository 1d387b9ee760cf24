"""Size of a video frame, read from the parameter set that a packet carries.

Bit layouts follow the published descriptions of H.264, H.265 and AV1; nothing is decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Profiles of H.264 whose parameter set tells the chroma format.
_WITH_CHROMA = (44, 83, 86, 100, 110, 118, 122, 128, 134, 135, 138, 139, 244)
# Luma samples a chroma sample covers, across and down, by chroma format.
_COVERS = {0: (1, 1), 1: (2, 2), 2: (2, 1), 3: (1, 1)}
_START = re.compile(b"\0\0\1")
#: A parameter set stands at the head of a packet.
MOST_BYTES = 1 << 16


class Bits:
    """Reads numbers from the bits of some bytes; past the end it raises ``EOFError``."""

    def __init__(self, data: bytes):
        self.value, self.left = int.from_bytes(data, "big"), 8 * len(data)

    def take(self, count: int) -> int:
        self.left -= count
        if self.left < 0:
            raise EOFError
        return self.value >> self.left & (1 << count) - 1

    def golomb(self) -> int:
        """An Exp-Golomb code: as many zeros as bits follow the next one."""
        zeros = 0
        while not self.take(1):
            zeros += 1
        return (1 << zeros | self.take(zeros)) - 1

    def signed(self) -> int:
        code = self.golomb()
        return (code + 1) // 2 if code % 2 else -(code // 2)


def _units(data: bytes) -> Iterator[bytes]:
    """Units between start codes, without the bytes that keep a start code from occurring inside."""
    starts = [m.end() for m in _START.finditer(data)]
    for begin, end in zip(starts, [*(s - 3 for s in starts[1:]), len(data)]):
        yield data[begin:end].replace(b"\0\0\3", b"\0\0")


def _skip_scaling(bits: Bits, count: int) -> None:
    last = following = 8
    for _ in range(count):
        if following:
            following = (last + bits.signed()) % 256
        last = following or last


def _h264(unit: bytes) -> tuple[int, int]:
    bits = Bits(unit[1:1025])
    profile, chroma, apart = bits.take(8), 1, 0
    bits.take(16)
    bits.golomb()
    if profile in _WITH_CHROMA:
        chroma = bits.golomb()
        apart = bits.take(1) if chroma == 3 else 0
        bits.golomb(), bits.golomb(), bits.take(1)
        if bits.take(1):
            for i in range(12 if chroma == 3 else 8):
                if bits.take(1):
                    _skip_scaling(bits, 16 if i < 6 else 64)
    bits.golomb()
    order = bits.golomb()
    if order == 0:
        bits.golomb()
    elif order == 1:
        bits.take(1), bits.signed(), bits.signed()
        for _ in range(bits.golomb()):
            bits.signed()
    bits.golomb(), bits.take(1)
    across, down, whole = bits.golomb() + 1, bits.golomb() + 1, bits.take(1)
    bits.take(1 if whole else 2)
    fields = 2 - whole
    x, y = (1, 1) if apart else _COVERS[chroma]
    crop = [bits.golomb() for _ in range(4)] if bits.take(1) else [0] * 4
    return fields * down * 16 - y * fields * (crop[2] + crop[3]), across * 16 - x * (crop[0] + crop[1])


def _hevc(unit: bytes) -> tuple[int, int]:
    bits = Bits(unit[2:1026])
    bits.take(4)
    layers = bits.take(3)
    bits.take(1 + 88 + 8)
    held = [(bits.take(1), bits.take(1)) for _ in range(layers)]
    bits.take(2 * (8 - layers) if layers else 0)
    for profile, level in held:
        bits.take(88 * profile + 8 * level)
    bits.golomb()
    chroma = bits.golomb()
    apart = bits.take(1) if chroma == 3 else 0
    width, height = bits.golomb(), bits.golomb()
    x, y = (1, 1) if apart else _COVERS[chroma]
    crop = [bits.golomb() for _ in range(4)] if bits.take(1) else [0] * 4
    return height - y * (crop[2] + crop[3]), width - x * (crop[0] + crop[1])


def _av1(data: bytes) -> tuple[int, int] | None:
    at = 0
    while at < len(data):
        head = data[at]
        at += 1 + (head >> 2 & 1)
        size = len(data) - at
        if head >> 1 & 1:
            size = shift = 0
            while True:
                size |= (data[at] & 127) << shift
                shift, at = shift + 7, at + 1
                if not data[at - 1] >> 7:
                    break
        if head >> 3 & 15 == 1:
            return _av1_sequence(Bits(data[at : at + min(size, 1024)]))
        at += size
    return None


def _av1_sequence(bits: Bits) -> tuple[int, int]:
    bits.take(4)
    if bits.take(1):
        bits.take(5)
    else:
        delay = 0
        if bits.take(1):
            bits.take(64)
            if bits.take(1):
                bits.golomb()
            if bits.take(1):
                delay = bits.take(5) + 1
                bits.take(32 + 10)
        shown = bits.take(1)
        for _ in range(bits.take(5) + 1):
            bits.take(12)
            if bits.take(5) > 7:
                bits.take(1)
            if delay and bits.take(1):
                bits.take(2 * delay + 1)
            if shown and bits.take(1):
                bits.take(4)
    across, down = bits.take(4) + 1, bits.take(4) + 1
    width = bits.take(across) + 1
    return bits.take(down) + 1, width


def size_of(data: bytes | None, codec: str | None) -> tuple[int | None, int | None]:
    """(height, width) by the first parameter set of a packet; null where it carries none."""
    data, found = (data or b"")[:MOST_BYTES], None
    try:
        if codec == "av1":
            found = _av1(data)
        elif codec == "h264":
            found = next((_h264(u) for u in _units(data) if u[:1] and u[0] & 31 == 7), None)
        elif codec == "hevc":
            found = next((_hevc(u) for u in _units(data) if u[:1] and u[0] >> 1 & 63 == 33), None)
    except (EOFError, IndexError, KeyError):
        return None, None
    return found if found and all(0 < n < 1 << 20 for n in found) else (None, None)


_SIZE = T.StructType([T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType())])


@F.pandas_udf(_SIZE)
def stream_size(samples: pd.Series, codecs: pd.Series) -> pd.DataFrame:
    """(height, width) of a video from one of its packets and its codec."""
    sizes = [size_of(s, c) for s, c in zip(samples, codecs, strict=True)]
    return pd.DataFrame(sizes, columns=["height", "width"]).astype("Int32")
