"""Media columns: bytes kept as FLAC streams of 8-bit mono samples, encoded and decoded here.

Streams follow the FLAC format (RFC 9639): STREAMINFO with the MD5 of the samples, a seek table with a point for every frame,
frames of 1,024 samples. Streams of other encoders, whose seek table has fewer points or which have none, are searched for
frames. The encoder picks constant, verbatim or fixed-predictor subframes with Rice-coded residuals; the
decoder also reads LPC subframes, partitioned Rice codes, escaped partitions and wasted bits. Every frame's CRC-8 and CRC-16
and the MD5 are verified. Many frames are worked on at a time: bits of all residuals are added into one buffer, and one
step of the decoder reads the next residual of every frame.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lilt.llm.common import append_columns, utf8

#: Samples in a frame, its code in frame headers, samples a second and their code, frames worked on at a time.
BLOCK, BLOCK_CODE, RATE, RATE_CODE, LANES = 1024, 10, 8000, 4, 2048
MAGIC = b"fLaC"


class CorruptStream(ValueError):
    """A checksum, length or field of a stream is wrong."""


def _crc_table(bits: int, polynomial: int) -> list[int]:
    table = []
    for byte in range(256):
        crc = byte << (bits - 8)
        for _ in range(8):
            crc = (crc << 1) ^ (polynomial if crc >> (bits - 1) else 0)
            crc &= (1 << bits) - 1
        table.append(crc)
    return table


CRC8, CRC16 = _crc_table(8, 0x07), np.array(_crc_table(16, 0x8005), np.uint16)


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = CRC8[crc ^ b]
    return crc


class _FrameSums:
    """CRC-16 of many frames: the checksum is linear, so each byte adds a term by its value and distance from the end."""

    def __init__(self) -> None:
        self.terms = CRC16[None, :]

    def grow(self, longest: int) -> None:
        rows = [self.terms]
        have = len(self.terms)
        last = self.terms[-1]
        while have < longest:
            last = (last << np.uint16(8)) ^ CRC16[last >> np.uint16(8)]
            rows.append(last[None, :])
            have += 1
        self.terms = np.concatenate(rows) if len(rows) > 1 else self.terms

    def of(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Checksums of the byte ranges [start, stop), none empty."""
        lengths = stops - starts
        self.grow(int(lengths.max()))
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = data[within + np.repeat(starts, lengths)]
        terms = self.terms.reshape(-1)[(np.repeat(lengths, lengths) - 1 - within) * 256 + values]
        return np.bitwise_xor.reduceat(terms, first)


_SUMS = _FrameSums()


def coded_number(n: int) -> bytes:
    """A frame or sample number in the extended UTF-8 of frame headers."""
    if n < 0x80:
        return bytes([n])
    tail = []
    limit = 0x40
    while n >= limit or not tail:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        limit = 0x40 >> len(tail)
    return bytes([(0xFF00 >> len(tail) + 1) & 0xFF | n] + tail[::-1])


def read_number(data: bytes, at: int) -> tuple[int, int]:
    """The number coded at a place and the place after it."""
    first = data[at]
    more = 0
    while first << more & 0x80:
        more += 1
    if more in (1, 8):
        raise CorruptStream("bad number in a frame header")
    n = first & (0x7F >> more)
    for b in data[at + 1 : at + max(more, 1)]:
        n = n << 6 | b & 0x3F
    return n, at + max(more, 1)


def read_header(data: bytes, at: int) -> tuple[int, int]:
    """Samples of the frame whose header begins at a place, and the place after the header, whose CRC-8 is verified."""
    begin = at
    try:
        if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
            raise CorruptStream("no frame at a place that should have one")
        code, rate = data[at + 2] >> 4, data[at + 2] & 15
        _, at = read_number(data, at + 4)
        if code == 0:
            raise CorruptStream("a reserved size of a frame")
        if code == 6:
            n, at = data[at] + 1, at + 1
        elif code == 7:
            n, at = int.from_bytes(data[at : at + 2], "big") + 1, at + 2
        else:
            n = 192 if code == 1 else 576 << code - 2 if code < 6 else 256 << code - 8
        at += 1 if rate == 12 else 2 if rate in (13, 14) else 0
        if crc8(data[begin:at]) != data[at]:
            raise CorruptStream("a frame header's CRC-8 is wrong")
    except IndexError as e:
        raise CorruptStream("a frame header ends early") from e
    return n, at + 1


def find_frames(data: bytes, first: int) -> list[tuple[int, int, int]]:
    """(first sample, byte from ``first``, samples) of every frame from a place on, found by their headers and CRC-16.

    Bytes inside a frame that pass for a header don't end it unless the checksum before them fits too.
    """
    raw = np.frombuffer(data, np.uint8)
    heads = {}
    for at in (np.flatnonzero((raw[first:-1] == 0xFF) & (raw[first + 1 :] & 0xFE == 0xF8)) + first).tolist():
        try:
            heads[at] = read_header(data, at)[0]
        except CorruptStream:
            continue
    ends, out, begin, sample = [*heads, len(data)], [], first, 0
    while begin < len(data):
        if begin not in heads:
            raise CorruptStream("no frame at a place that should have one")
        for end in ends[bisect_right(ends, begin) :]:
            if end - begin >= 9 and _SUMS.of(raw, np.array([begin]), np.array([end - 2]))[0] == int.from_bytes(data[end - 2 : end], "big"):
                break
        else:
            raise CorruptStream("a frame's CRC-16 is wrong")
        out.append((sample, begin - first, heads[begin]))
        sample, begin = sample + heads[begin], end
    return out


def frame_header(number: int, samples: int) -> bytes:
    size = b"" if samples == BLOCK else (samples - 1).to_bytes(2, "big")
    head = bytes([0xFF, 0xF8, (BLOCK_CODE if not size else 7) << 4 | RATE_CODE, 0x02]) + coded_number(number) + size
    return head + bytes([crc8(head)])


def encode_frames(samples: list[np.ndarray], numbers: list[int]) -> list[bytes]:
    """Frames of blocks of int8 samples, each 1 to 1,024 long."""
    out: list[bytes] = [b""] * len(samples)
    lengths = np.array([len(s) for s in samples])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        for part in np.split(at, range(LANES, len(at), LANES)):
            for i, frame in zip(part, _encode_equal(np.stack([samples[i] for i in part]).astype(np.int32), [numbers[i] for i in part]), strict=True):
                out[i] = frame
    return out


def _encode_equal(x: np.ndarray, numbers: list[int]) -> list[bytes]:
    """Frames of blocks of equal length, the rows of x."""
    rows, n = x.shape
    verbatim = np.full(rows, 8 * n)
    bits = [verbatim]
    plans = []
    residual = x
    for order in range(min(3, n)):
        if order:
            residual = np.diff(residual, axis=1)
        z = (residual << 1) ^ (residual >> 31)
        mean = z.mean(axis=1)
        k = np.clip(np.floor(np.log2(np.maximum(mean * 0.7, 1))), 0, 14).astype(np.int32)
        bits.append(8 * order + 10 + (z >> k[:, None]).sum(axis=1) + (1 + k) * (n - order))
        plans.append((z, k))
    choice = np.argmin(np.stack(bits), axis=0) - 1
    constant = (x == x[:, :1]).all(axis=1)
    choice[constant] = -2
    heads = [frame_header(i, n) for i in numbers]
    body = np.select([choice == -2, choice == -1], [8, 8 * n], np.stack(bits)[np.maximum(choice, -1) + 1, np.arange(rows)])
    sizes = np.array([len(h) for h in heads]) + 1 + (body + 7) // 8
    starts = np.concatenate([[0], np.cumsum(sizes)])
    buffer = np.zeros(starts[-1] + 4, np.uint8)
    for i, head in enumerate(heads):
        at = starts[i] + len(head)
        buffer[starts[i] : at] = np.frombuffer(head, np.uint8)
        kind = int(choice[i])
        buffer[at] = 0 if kind == -2 else 2 if kind == -1 else (8 | kind) << 1
        if kind < 0:
            count = 1 if kind == -2 else n
        else:
            count = kind
        buffer[at + 1 : at + 1 + count] = x[i, :count].astype(np.int8).view(np.uint8)
    first_bit = 8 * (starts[:-1] + np.array([len(h) for h in heads]) + 1)
    for order, (z, k) in enumerate(plans):
        at = np.flatnonzero(choice == order)
        if not len(at):
            continue
        z, k = z[at].astype(np.int64), k[at].astype(np.int64)
        begin = first_bit[at] + 8 * order
        _add_bits(buffer, begin + 6, k, np.full(len(at), 4))
        q = z >> k[:, None]
        ends = np.cumsum(q + 1 + k[:, None], axis=1) + (begin + 10)[:, None]
        value = (1 << k)[:, None] | z & ((1 << k) - 1)[:, None]
        width = np.broadcast_to((k + 1)[:, None], z.shape)
        _add_bits(buffer, (ends - width).reshape(-1), value.reshape(-1), width.reshape(-1))
    sums = _SUMS.of(buffer, starts[:-1], starts[1:])
    data = buffer.tobytes()
    return [data[a:b] + int(c).to_bytes(2, "big") for a, b, c in zip(starts[:-1].tolist(), starts[1:].tolist(), sums, strict=True)]


def _add_bits(buffer: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray) -> None:
    """Adds values of at most 16 bits, whose bits don't overlap, at bit positions of a buffer."""
    low, byte = value << (24 - (at & 7) - width), at >> 3
    base, top = int(byte.min()), int(byte.max())
    total = np.zeros(top - base + 3)
    for j in range(3):
        part = np.bincount(byte - base, (low >> (16 - 8 * j)) & 0xFF, top - base + 1)
        total[j : j + len(part)] += part
    stop = min(base + len(total), len(buffer))
    buffer[base:stop] += total[: stop - base].astype(np.uint8)


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload, a non-empty run of bytes; byte b is sample b - 128."""
    signed = [np.frombuffer(p, np.uint8) ^ np.uint8(0x80) for p in payloads]
    blocks, numbers, counts = [], [], []
    for s in signed:
        counts.append(-(-len(s) // BLOCK))
        for i in range(counts[-1]):
            blocks.append(s[i * BLOCK : (i + 1) * BLOCK].view(np.int8))
            numbers.append(i)
    frames, at, out = encode_frames(blocks, numbers), 0, []
    for s, count in zip(signed, counts, strict=True):
        own = frames[at : at + count]
        at += count
        sizes = [len(f) for f in own]
        points = np.zeros(count, [("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")])
        points["sample"] = np.arange(count) * BLOCK
        points["offset"] = np.cumsum([0] + sizes[:-1])
        points["samples"] = [BLOCK] * (count - 1) + [len(s) - BLOCK * (count - 1)]
        fields = RATE << 44 | 0 << 41 | 7 << 36 | len(s)
        info = BLOCK.to_bytes(2, "big") * 2 + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + fields.to_bytes(8, "big") + hashlib.md5(s.tobytes()).digest()
        tables, limit = [], (1 << 24) // 18 - 1
        for a in range(0, count, limit):
            table = points[a : a + limit].tobytes()
            tables.append(bytes([3]) + len(table).to_bytes(3, "big") + table)
        tables[-1] = bytes([0x83]) + tables[-1][1:]
        out.append(b"".join([MAGIC, b"\x00", len(info).to_bytes(3, "big"), info, *tables, *own]))
    return out


POINT = [("sample", ">u8"), ("offset", ">u8"), ("samples", ">u2")]


class Stream:
    """A stream's fields, and a point for every frame: from the seek table if it has them all, else from a search."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != MAGIC:
            raise CorruptStream("no FLAC stream")
        self.data, at, last, points = data, 4, False, []
        self.info = b""
        while not last:
            last, kind, size = data[at : at + 1] > b"\x7f", int.from_bytes(data[at : at + 1], "big") & 127, int.from_bytes(data[at + 1 : at + 4], "big")
            body = data[at + 4 : at + 4 + size]
            at += 4 + size
            if at > len(data):
                raise CorruptStream("the stream ends in its head")
            if kind == 0:
                self.info = body
            elif kind == 3:
                points.append(np.frombuffer(body, POINT, len(body) // 18))
        if len(self.info) < 34:
            raise CorruptStream("no STREAMINFO")
        fields = int.from_bytes(self.info[10:18], "big")
        self.bits, self.total, self.md5, self.first = (fields >> 36 & 31) + 1, fields & (1 << 36) - 1, self.info[18:34], at
        if self.bits != 8 or fields >> 41 & 7:
            raise CorruptStream("only 8-bit mono streams are read")
        table = np.concatenate(points) if points else np.zeros(0, POINT)
        table = table[table["sample"] != 0xFFFFFFFFFFFFFFFF]
        stops = np.cumsum(table["samples"].astype(np.int64))
        whole = len(table) and stops[-1] == self.total and (table["sample"][0] == 0) and (table["sample"][1:] == stops[:-1]).all()
        self.points = table if whole else np.array(find_frames(data, at), POINT)
        if not self.total and len(self.points):
            self.total = int(self.points["samples"].astype(np.int64).sum())

    def frames(self, start: int = 0, stop: int | None = None) -> list[tuple[int, int]]:
        """Byte ranges of the frames that hold samples from start to stop."""
        stop = self.total if stop is None else stop
        offsets = np.append(self.points["offset"].astype(np.int64) + self.first, len(self.data))
        sample = self.points["sample"].astype(np.int64)
        a, b = max(0, int(np.searchsorted(sample, start, side="right")) - 1), int(np.searchsorted(sample, stop, side="left"))
        return [(int(offsets[i]), int(offsets[i + 1])) for i in range(a, b)]


def decode_frames(data: bytes, ranges: list[tuple[int, int]]) -> list[np.ndarray]:
    """int8 samples of the frames at byte ranges of a buffer, which must fill them; all checksums are verified."""
    out: list[np.ndarray] = []
    for at in range(0, len(ranges), LANES):
        out += _decode_some(data, ranges[at : at + LANES])
    return out


def _decode_some(data: bytes, ranges: list[tuple[int, int]]) -> list[np.ndarray]:
    low, high = min(a for a, _ in ranges), max(b for _, b in ranges)
    data = data[low:high]
    ranges = [(a - low, b - low) for a, b in ranges]
    raw = np.frombuffer(data + bytes(8), np.uint8)
    starts, stops = np.array([a for a, _ in ranges]), np.array([b for _, b in ranges])
    if (stops - starts < 9).any():
        raise CorruptStream("a frame is too short")
    sums = _SUMS.of(raw, starts, stops - 2)
    if (sums != (raw[stops - 2].astype(np.uint16) << np.uint16(8) | raw[stops - 1])).any():
        raise CorruptStream("a frame's CRC-16 is wrong")
    out: list[np.ndarray | None] = [None] * len(ranges)
    lanes: list[tuple[int, int, int, int, int]] = []
    for i, (a, b) in enumerate(ranges):
        n, at = read_header(data, a)
        kind, at = data[at], at + 1
        if kind == 0:
            out[i] = np.full(n, data[at], np.uint8).view(np.int8)
        elif kind == 2:
            out[i] = np.frombuffer(data, np.int8, n, at)
        elif kind & 1 or not 16 <= kind <= 25 or data[at + (order := kind >> 1 & 7)] >> 2 or (k := (data[at + order] & 3) << 2 | data[at + order + 1] >> 6) == 15:
            out[i] = _decode_general(data[a:b], 8 * (at - 1 - a), n)
        else:
            lanes.append((i, n, order, k, 8 * (at + order) + 10))
    if lanes:
        lanes.sort(key=lambda x: x[2] - x[1])
        index, n, order, k, place = (np.array(c) for c in zip(*lanes, strict=True))
        for j, (z, end) in enumerate(zip(*_rice(raw, place, n - order, k), strict=True)):
            i, o = int(index[j]), int(order[j])
            if (end + 7) // 8 + 2 != ranges[i][1]:
                raise CorruptStream("a frame's residuals end at another place")
            warm = np.frombuffer(data, np.int8, o, (int(place[j]) - 10) // 8 - o).astype(np.int32)
            d = (z >> 1) ^ -(z & 1)
            for m in range(o - 1, -1, -1):
                d = np.cumsum(d) + np.diff(warm, m)[-1]
            out[i] = np.concatenate([warm, d]).astype(np.int8)
    return out  # type: ignore[return-value]


def _rice(raw: np.ndarray, place: np.ndarray, counts: np.ndarray, k: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rice codes of many lanes, which begin at bit places; counts descend. Values by lane, and where each lane ends."""
    bits = np.unpackbits(raw)
    ones = np.where(bits.view(bool), np.arange(len(bits), dtype=np.int32), np.int32(len(bits)))
    following = np.minimum.accumulate(ones[::-1])[::-1]
    wide = raw.astype(np.uint32)
    wide = np.append((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]), [0, 0]).astype(np.int64)
    at, k = place.astype(np.int64), k.astype(np.int64)
    values = np.zeros((int(counts[0]) if len(counts) else 0, len(at)), np.int32)
    active = np.searchsorted(-counts, -np.arange(len(values)), side="left")
    shift, mask = 24 - k, (1 << k) - 1
    for step, m in enumerate(active.tolist()):
        p = at[:m]
        one = following[np.minimum(p, len(following) - 1)].astype(np.int64)
        after = one + 1
        word = wide[np.minimum(after >> 3, len(wide) - 1)]
        values[step, :m] = (one - p) << k[:m] | (word >> (shift[:m] - (after & 7))) & mask[:m]
        at[:m] = after + k[:m]
    return [values[:c, j] for j, c in enumerate(counts.tolist())], at


def _decode_general(frame: bytes, at: int, n: int) -> np.ndarray:
    """Samples of one frame with any kind of subframe, which begins at a bit."""
    whole, length = int.from_bytes(frame, "big"), 8 * len(frame)

    def take(width: int, signed: bool = False) -> int:
        nonlocal at
        at += width
        if at > length:
            raise CorruptStream("a frame ends early")
        value = whole >> (length - at) & (1 << width) - 1
        return value - (1 << width) if signed and width and value >> width - 1 else value

    def unary() -> int:
        count = 0
        while not take(1):
            count += 1
        return count

    take(1)
    kind, wasted = take(6), 0
    if take(1):
        wasted = unary() + 1
    width = 8 - wasted
    if kind == 0:
        return np.full(n, take(width, True) << wasted, np.int32).astype(np.int8)
    if kind == 1:
        return np.array([take(width, True) << wasted for _ in range(n)], np.int32).astype(np.int8)
    if 8 <= kind <= 12:
        order = kind - 8
        warm = [take(width, True) for _ in range(order)]
        taps, move = [[], [1], [2, -1], [3, -3, 1], [4, -6, 4, -1]][order], 0
    elif kind >= 32:
        order = kind - 31
        warm = [take(width, True) for _ in range(order)]
        precision, move = take(4) + 1, take(5, True)
        taps = [take(precision, True) for _ in range(order)]
    else:
        raise CorruptStream("a reserved kind of subframe")
    method, partitions = take(2), 1 << take(4)
    if method > 1 or n % partitions:
        raise CorruptStream("a bad residual")
    x = warm
    for part in range(partitions):
        size = n // partitions - (order if part == 0 else 0)
        k = take(5 if method else 4)
        escaped = take(5) if k == (31 if method else 15) else None
        for _ in range(size):
            if escaped is not None:
                e = take(escaped, True)
            else:
                z = unary() << k | take(k)
                e = z >> 1 ^ -(z & 1)
            x.append(e + (sum(c * x[-1 - i] for i, c in enumerate(taps)) >> move))
    return (np.array(x, np.int64) << wasted).astype(np.int8)


def decode(streams: list[bytes]) -> list[bytes]:
    """The payloads of streams; raises CorruptStream if any checksum is wrong. An MD5 of zeros says that there is none."""
    parsed = [Stream(s) for s in streams]
    base, ranges, counts = 0, [], []
    for s in parsed:
        own = s.frames()
        ranges += [(a + base, b + base) for a, b in own]
        counts.append(len(own))
        base += len(s.data)
    frames, at, out = decode_frames(b"".join(streams), ranges), 0, []
    for s, count in zip(parsed, counts, strict=True):
        samples = np.concatenate(frames[at : at + count]) if count else np.zeros(0, np.int8)
        at += count
        if len(samples) != s.total or any(s.md5) and hashlib.md5(samples.tobytes()).digest() != s.md5:
            raise CorruptStream("the samples' number or MD5 is wrong")
        out.append((samples.view(np.uint8) ^ np.uint8(0x80)).tobytes())
    return out


def read_samples(stream: bytes, start: int, count: int) -> bytes:
    """Payload bytes from start on, decoding only the frames that hold them."""
    s = Stream(stream)
    start = max(0, min(start, s.total))
    stop = max(start, min(start + count, s.total))
    if start == stop:
        return b""
    frames = np.concatenate(decode_frames(s.data, s.frames(start, stop)))
    skip = start - int(s.points["sample"][max(0, int(np.searchsorted(s.points["sample"], start, side="right")) - 1)])
    return (frames[skip : skip + stop - start].view(np.uint8) ^ np.uint8(0x80)).tobytes()


def padded(data: bytes | None, multiple: int = 64) -> bytes:
    """Bytes 0 appended up to a positive multiple."""
    data = data or b""
    return data + bytes(max(multiple, -(-len(data) // multiple) * multiple) - len(data))


def features(payload: bytes) -> str:
    """Signal features of a payload's samples: number, range, mean, root mean square and sign changes, from exact integers."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"n={len(x)};min={x.min()};max={x.max()};mean={int(x.sum()) / len(x):.4f};rms={(int((x * x).sum()) / len(x)) ** 0.5:.4f};crossings={crossings}"


def _groups(items: list[bytes], most: int = 1 << 21) -> Iterable[list[bytes]]:
    """Consecutive items of at most so many bytes together, or one."""
    own: list[bytes] = []
    size = 0
    for x in items:
        if own and size + len(x) > most:
            yield own
            own, size = [], 0
        own.append(x)
        size += len(x)
    if own:
        yield own


def media_column(docs: DataFrame, text_col: str = "text", only: list[str] | None = None) -> DataFrame:
    """docs with ``media`` (binary, a FLAC stream), ``payload`` (binary, decoded from it), ``offsets`` and ``feature``.

    The payload is the text as UTF-8 with bytes 0 appended up to a positive multiple of 64; a null text counts as empty.
    offsets lists (sample, byte) for every frame, so PCM blocks can be read from the middle. Rows are independent: equal
    texts have equal values, repeated rows return each. A long text is one stream of many frames, worked on LANES frames at
    a time. An empty table gives no rows. Input columns named like the new ones are replaced.
    """

    def make():
        def kernel(batch: pa.RecordBatch) -> list[pa.Array]:
            media, payloads = [], []
            for group in _groups([padded(t) for t in utf8(batch.column(text_col))]):
                made = encode(group)
                media += made
                payloads += decode(made)
            offsets = []
            for m in media:
                s = Stream(m)
                offsets.append([{"sample": int(p["sample"]), "byte": int(p["offset"]) + s.first} for p in s.points])
            place = pa.list_(pa.struct([("sample", pa.int64()), ("byte", pa.int64())]))
            return [pa.array(media, pa.binary()), pa.array(payloads, pa.binary()), pa.array(offsets, place), pa.array([features(p) for p in payloads])]

        return kernel

    place = T.StructType([T.StructField("sample", T.LongType()), T.StructField("byte", T.LongType())])
    fields = [T.StructField("media", T.BinaryType()), T.StructField("payload", T.BinaryType()), T.StructField("offsets", T.ArrayType(place)), T.StructField("feature", T.StringType())]
    return append_columns(docs, make, fields, only)
