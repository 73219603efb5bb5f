"""SHA-256 that can be put down and taken up again elsewhere: a sequence is hashed by one task after the other.

A state is 32 bytes of hash, 8 of length, and what of the last block is there. hashlib keeps its own state to itself, so whole
blocks go to OpenSSL's functions, which Python links for hashlib; where they can't be found Python does it, slowly.
"""

from __future__ import annotations

import ctypes
import functools
import struct

_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, int(p**0.5) + 1))]
_ROUNDS = [int(p ** (1 / 3) % 1 * 2**32) for p in _PRIMES]

#: The state before anything is read.
START = struct.pack(">8IQ", *(int(p**0.5 % 1 * 2**32) for p in _PRIMES[:8]), 0)


@functools.cache
def _openssl() -> ctypes.CDLL | None:
    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        lib.SHA256_Init.argtypes, lib.SHA256_Update.argtypes = [ctypes.c_void_p], [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
        return lib
    except (ImportError, OSError, AttributeError):
        return None


def _turned(x: int, n: int) -> int:
    return (x >> n | x << (32 - n)) & 0xFFFFFFFF


def _plain(now: tuple[int, ...], blocks: bytes) -> tuple[int, ...]:
    for start in range(0, len(blocks), 64):
        w = list(struct.unpack_from(">16I", blocks, start))
        for t in range(16, 64):
            one, two = w[t - 15], w[t - 2]
            s0, s1 = _turned(one, 7) ^ _turned(one, 18) ^ one >> 3, _turned(two, 17) ^ _turned(two, 19) ^ two >> 10
            w.append((w[t - 16] + s0 + w[t - 7] + s1) & 0xFFFFFFFF)
        a, b, c, d, e, f, g, h = now
        for k, x in zip(_ROUNDS, w, strict=True):
            one = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (e & f ^ ~e & g) + k + x
            two = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + (a & b ^ a & c ^ b & c)
            a, b, c, d, e, f, g, h = (one + two) & 0xFFFFFFFF, a, b, c, (d + one) & 0xFFFFFFFF, e, f, g
        now = tuple((x + y) & 0xFFFFFFFF for x, y in zip(now, (a, b, c, d, e, f, g, h), strict=True))
    return now


def _compressed(now: tuple[int, ...], blocks: bytes) -> tuple[int, ...]:
    lib = _openssl()
    if lib is None:
        return _plain(now, blocks)
    context = ctypes.create_string_buffer(256)  # its first 32 bytes are the hash, as eight numbers
    lib.SHA256_Init(context)
    struct.pack_into("=8I", context, 0, *now)
    lib.SHA256_Update(context, blocks, len(blocks))
    return struct.unpack_from("=8I", context, 0)


def read_on(state: bytes, data: bytes) -> bytes:
    """The state after ``data`` as well."""
    *now, length = struct.unpack_from(">8IQ", state)
    data = state[40:] + data
    whole = len(data) // 64 * 64
    return struct.pack(">8IQ", *_compressed(tuple(now), data[:whole]), length + len(data) - len(state[40:])) + data[whole:]


def hex_digest(state: bytes) -> str:
    """The digest of what was read so far."""
    *now, length = struct.unpack_from(">8IQ", state)
    rest = state[40:] + b"\x80"
    rest += bytes(-(len(rest) + 8) % 64) + struct.pack(">Q", 8 * length)
    return struct.pack(">8I", *_compressed(tuple(now), rest)).hex()
