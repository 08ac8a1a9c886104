"""Range-coded difference blocks (RED) of the Mayo EEG formats, and their checksum."""

from __future__ import annotations

import struct
from bisect import bisect_right

import numpy as np

from sigloom.functions.crypto import decrypt_block

#: Fixed values of the format: bits of the first byte in the coder, and the least range before it takes a byte.
FIRST_BITS, LEAST_RANGE = 7, 0x800000
#: Fixed value: the reflected 32-bit Koopman polynomial.
KOOPMAN = 0xEB31D82E


def koopman_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(KOOPMAN), t >> 1).astype(np.uint32)
    return t


_TABLE = koopman_table().tolist()


def crc32_koopman(data: bytes, crc: int = 0xFFFFFFFF) -> int:
    for b in data:
        crc = (crc >> 8) ^ _TABLE[(crc ^ b) & 0xFF]
    return crc


def range_decode(data: bytes, start: int, counts: bytes, n: int) -> bytearray:
    """n symbols coded under the given counts, from data[start:]."""
    cumulative = [0]
    for c in counts:
        cumulative.append(cumulative[-1] + c)
    total = cumulative[-1]
    if not total:
        raise ValueError("a block without a model")
    out = bytearray(n)
    data = data + b"\0\0\0\0\0\0\0\0"
    byte, at = data[start], start + 1
    low, span = byte >> (8 - FIRST_BITS), 1 << FIRST_BITS
    for i in range(n):
        while span <= LEAST_RANGE:
            low = (low << 8) | ((byte << FIRST_BITS) & 0xFF)
            byte = data[at] if at < len(data) else 0
            at += 1
            low |= byte >> (8 - FIRST_BITS)
            span <<= 8
        unit = span // total
        s = bisect_right(cumulative, min(low // unit, total - 1)) - 1
        base = unit * cumulative[s]
        low -= base
        span = unit * counts[s] if s < 255 else span - base
        out[i] = s
    return out


def undo_differences(symbols: bytes, n: int, key_bytes: int) -> np.ndarray:
    """Values from differences of a byte; -128 marks a whole value of key_bytes bytes. The first mark isn't coded."""
    s = np.frombuffer(b"\x80" + bytes(symbols), np.int8)
    out = np.empty(n, np.int64)
    at = done = 0
    value = 0
    while done < n:
        if s[at] == -128:
            value = int.from_bytes(s[at + 1 : at + 1 + key_bytes].tobytes(), "little", signed=True)
            at += 1 + key_bytes
            out[done] = value
            done += 1
            continue
        marks = np.flatnonzero(s[at:] == -128)
        stop = min(at + (int(marks[0]) if len(marks) else len(s) - at), at + n - done)
        if stop == at:
            raise ValueError("a block ends before its samples do")
        run = value + np.cumsum(s[at:stop].astype(np.int64))
        out[done : done + len(run)] = run
        value, done, at = int(run[-1]), done + len(run), stop
    return out


def check_block(block: bytes, crc: int) -> None:
    if crc32_koopman(block[4:]) != crc:
        raise ValueError("a block's checksum doesn't match")


def decode_mef2(block: bytes, validate: bool = False, key: bytes | None = None) -> tuple[int, np.ndarray, bool]:
    """Start time, samples and whether a gap comes before the block. key: of a block whose model is encrypted."""
    crc, size, t, n_diff, n = struct.unpack_from("<IIQII", block)
    if validate:
        check_block(block[: 287 + size], crc)
    if key is not None:
        block = block[:31] + decrypt_block(block[31:47], key) + block[47:]
    symbols = range_decode(block, 288, block[31:287], n_diff)
    return t, undo_differences(symbols, n, 3), bool(block[30])


def decode_mef3(block: bytes, validate: bool = False, keys: tuple[bytes | None, bytes | None] = (None, None)) -> tuple[int, np.ndarray, bool]:
    """keys: of levels 1 and 2, for blocks whose model is encrypted."""
    crc, flags = struct.unpack_from("<IB", block)
    slope, intercept, factor, n_diff, n, size, t = struct.unpack_from("<fffIIIq", block, 16)
    if validate:
        check_block(block[:size], crc)
    if flags & 0x06:
        key = keys[0] if flags & 0x02 else keys[1]
        if key is None:
            raise ValueError("an encrypted block needs its password")
        block = block[:48] + decrypt_block(block[48:64], key) + block[64:]
    if not n:
        return t, np.zeros(0, np.int64), bool(flags & 1)
    x = undo_differences(range_decode(block, 304, block[48:304], n_diff), n, 4)
    if factor > 1:
        x = round_away(x * factor).astype(np.int64)
    if slope or intercept:
        x = round_away(x + (slope * np.arange(1, n + 1) + intercept)).astype(np.int64)
    return t, x, bool(flags & 1)


def round_away(x: np.ndarray) -> np.ndarray:
    """To whole numbers, halves away from zero."""
    return np.trunc(x + np.copysign(0.5, x))


def encode_differences(x: np.ndarray, key_bytes: int) -> bytes:
    """The inverse of undo_differences, without the first mark."""
    out = bytearray(int(x[0]).to_bytes(key_bytes, "little", signed=True))
    for d, v in zip(np.diff(x).tolist(), x[1:].tolist()):
        if -127 <= d <= 127:
            out += struct.pack("b", d)
        else:
            out += b"\x80" + int(v).to_bytes(key_bytes, "little", signed=True)
    return bytes(out)


def model_of(symbols: bytes) -> bytes:
    """Counts scaled to a byte each; symbols that occur have 1 at least."""
    n = np.bincount(np.frombuffer(symbols, np.uint8), minlength=256).astype(float)
    scaled = np.where(n > 0, np.maximum(1, np.floor(n * 254 / max(n.max(), 1))), 0)
    return scaled.astype(np.uint8).tobytes()


def range_encode(symbols: bytes, counts: bytes) -> bytes:
    """Codes symbols under the counts; the low end is kept as one whole number, so that carries need no care."""
    cumulative = np.r_[0, np.cumsum(np.frombuffer(counts, np.uint8).astype(np.int64))].tolist()
    total = cumulative[-1]
    low, span, bits = 0, 1 << FIRST_BITS, FIRST_BITS
    for s in symbols:
        while span <= LEAST_RANGE:
            low, span, bits = low << 8, span << 8, bits + 8
        unit = span // total
        low += unit * cumulative[s]
        span = unit * counts[s] if s < 255 else span - unit * cumulative[s]
    code = low + span // 2
    pad = -bits % 8
    return (code << pad).to_bytes((bits + pad) // 8, "big") + b"\0\0\0\0"


def encode_mef2(t: int, x: np.ndarray, gap: bool = False) -> bytes:
    symbols = encode_differences(x, 3)
    model = model_of(symbols)
    data = b"\0" + range_encode(symbols, model)
    edge = lambda v: int(v).to_bytes(3, "little", signed=True)
    body = struct.pack("<IQII", len(data), t, len(symbols), len(x)) + edge(x.max()) + edge(x.min()) + bytes([gap]) + model + data
    return struct.pack("<I", crc32_koopman(body)) + body


def encode_mef3(t: int, x: np.ndarray, gap: bool = False, factor: float = 1.0, slope: float = 0.0, intercept: float = 0.0) -> bytes:
    """x as it is coded: without the line that slope and intercept give back, and divided by the factor."""
    symbols = encode_differences(x, 4)
    model = model_of(symbols)
    data = range_encode(symbols, model)
    size = 304 + len(data)
    pad = -size % 8
    body = bytes([1 if gap else 0]) + bytes(11) + struct.pack("<fffIIIq", slope, intercept, factor, len(symbols), len(x), size + pad, t) + model + data + b"\x7e" * pad
    return struct.pack("<I", crc32_koopman(body)) + body
