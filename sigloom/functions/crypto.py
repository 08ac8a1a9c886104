"""AES-128 on single blocks and the password checks of MEF 3 files.

Spark's aes_decrypt has no raw block mode, so the few blocks a file has are decrypted here. Tables come from their rules.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache


def _double(x: int) -> int:
    return ((x << 1) ^ 0x11B) & 0xFF if x & 0x80 else x << 1


def multiply(a: int, b: int) -> int:
    """In the field of 256 elements."""
    out = 0
    while b:
        if b & 1:
            out ^= a
        a, b = _double(a), b >> 1
    return out


def _boxes() -> tuple[list[int], list[int]]:
    box = [0] * 256
    for x in range(256):
        inverse = next((y for y in range(256) if multiply(x, y) == 1), 0)
        s = inverse
        for k in range(1, 5):
            s ^= ((inverse << k) | (inverse >> (8 - k))) & 0xFF
        box[x] = s ^ 0x63
    back = [0] * 256
    for i, v in enumerate(box):
        back[v] = i
    return box, back


SBOX, INVERSE = _boxes()
#: Products of every byte with the factors of the rounds.
PRODUCTS = {f: bytes(multiply(x, f) for x in range(256)) for f in (1, 2, 3, 9, 11, 13, 14)}


@lru_cache(maxsize=64)
def expand_key(key: bytes) -> list[bytes]:
    """Eleven round keys."""
    words, constant = [list(key[i : i + 4]) for i in range(0, 16, 4)], 1
    while len(words) < 44:
        w = list(words[-1])
        if len(words) % 4 == 0:
            w = [SBOX[x] for x in w[1:] + w[:1]]
            w[0] ^= constant
            constant = _double(constant)
        words.append([a ^ b for a, b in zip(w, words[-4])])
    return [bytes(sum(words[i : i + 4], [])) for i in range(0, 44, 4)]


def _mix(state: list[int], row: tuple[int, int, int, int]) -> list[int]:
    p, q, s, t = (PRODUCTS[f] for f in row)
    turns = ((p, q, s, t), (t, p, q, s), (s, t, p, q), (q, s, t, p))
    return [a[state[4 * c]] ^ b[state[4 * c + 1]] ^ d[state[4 * c + 2]] ^ e[state[4 * c + 3]] for c in range(4) for a, b, d, e in turns]


def _add(state, key) -> list[int]:
    return [a ^ b for a, b in zip(state, key)]


def decrypt_block(block: bytes, key: bytes) -> bytes:
    keys = expand_key(key)
    state = _add(block, keys[10])
    for k in range(9, -1, -1):
        state = [INVERSE[state[4 * ((c - r) % 4) + r]] for c in range(4) for r in range(4)]
        state = _add(state, keys[k])
        if k:
            state = _mix(state, (14, 11, 13, 9))
    return bytes(state)


def encrypt_block(block: bytes, key: bytes) -> bytes:
    keys = expand_key(key)
    state = _add(block, keys[0])
    for k in range(1, 11):
        state = [SBOX[state[4 * ((c + r) % 4) + r]] for c in range(4) for r in range(4)]
        if k < 10:
            state = _mix(state, (2, 3, 1, 1))
        state = _add(state, keys[k])
    return bytes(state)


def decrypt(data: bytes, key: bytes) -> bytes:
    return b"".join(decrypt_block(data[i : i + 16], key) for i in range(0, len(data), 16))


def password_key(password: str) -> bytes:
    """The last byte of each of the first 16 characters, filled up with zeros."""
    return bytes(c.encode()[-1] for c in password[:16]).ljust(16, b"\0")


def mef3_access(header: bytes, password: str | None) -> tuple[int, bytes | None, bytes | None]:
    """Level that the password opens (0: none) and the keys of levels 1 and 2, by the validation fields of a universal header."""
    first, second = header[868:884], header[884:900]
    if password is None or not any(first):
        return 0, None, None
    key = password_key(password)
    digest = hashlib.sha256(key).digest()[:16]
    if digest == first:
        return 1, key, None
    below = bytes(a ^ b for a, b in zip(digest, second))
    if any(second) and hashlib.sha256(below).digest()[:16] == first:
        return 2, below, key
    return 0, None, None


def mef2_key(password: str) -> bytes:
    """The password's first 16 bytes, filled up with zeros."""
    return password.encode()[:16].ljust(16, b"\0")


def mef2_opens(field: bytes, password: str) -> bool:
    """Whether a validation field, decrypted with the password, holds it: a byte of length and its characters."""
    data = decrypt_block(field, mef2_key(password))
    return data[0] < 16 and data[1 : 1 + data[0]] == password.encode()


def mef2_access(header: bytes, password: str | None) -> tuple[bytes, int, bytes | None]:
    """A MEF 2 header with what the password opens decrypted; the level (1: subject, 2: session, 0: none); the key of encrypted blocks.

    The subject's password opens the subject's fields, among them the session's password, which opens the
    session's fields and the blocks. A session's password opens these alone.
    """
    subject, session, data = header[160:163]
    if not (subject or session):
        return header, 0, mef2_key(password) if data and password is not None else None
    level = 0
    if password is not None:
        level = 1 if mef2_opens(header[320:336], password) else 2 if mef2_opens(header[352:368], password) else 0
    if subject and level == 1:
        header = header[:176] + decrypt(header[176:336], mef2_key(password)) + header[336:]
        if session:
            password = header[304:320].split(b"\0")[0].decode("utf-8", "replace")
    if session and level:
        header = header[:352] + decrypt(header[352:864], mef2_key(password)) + header[864:]
    return header, level, mef2_key(password) if data and level else None
