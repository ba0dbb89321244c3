"""Elias-Fano sequences and the n-gram trie made of them.

A monotone sequence is cut into blocks of ``BLOCK`` values.  In a block the low bits of the
values (less the block's first one) stand in a bit array, and the high bits in unary in
another.  Successor search finds a target's block by the blocks' first values and decodes
only the blocks that targets fall into.

All arrays of a trie stand one after another in one buffer behind a small header; they are
read in place, from bytes as well as from a file that is mapped into memory.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

BLOCK = 1 << 15
U = np.uint64


def as_sequence(values: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a non-decreasing sequence."""
    values = np.asarray(values, U)
    first, width, low_at, high_at, lows, highs = [], [], [0], [0], [], []
    for at in range(0, len(values), BLOCK):
        own = values[at:at + BLOCK]
        first.append(own[0])
        own = own - own[0]
        bits = max(0, int(own[-1]) // len(own)).bit_length()
        bits = bits - 1 if bits else 0
        width.append(bits)
        low = (own[:, None] >> np.arange(bits, dtype=U)[None, :] & U(1)).astype(np.uint8)
        lows.append(np.packbits(low.ravel()))
        up = (own >> U(bits)).astype(np.int64)
        unary = np.zeros(len(own) + int(up[-1]) + 1, np.uint8)
        unary[up + np.arange(len(own))] = 1
        highs.append(np.packbits(unary))
        low_at.append(low_at[-1] + len(lows[-1]))
        high_at.append(high_at[-1] + len(highs[-1]))
    none = [np.zeros(0, np.uint8)]
    return {"size": np.array([len(values)], np.int64), "first": np.array(first, U), "width": np.array(width, np.uint8),
            "low_at": np.array(low_at, np.int64), "high_at": np.array(high_at, np.int64),
            "lows": np.concatenate(lows or none), "highs": np.concatenate(highs or none)}


class Sequence:
    """A sequence over the arrays of ``as_sequence``; decoded blocks are kept while it is."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a, self.size, self._blocks = arrays, int(arrays["size"][0]), {}

    def block(self, k: int) -> np.ndarray:
        if k not in self._blocks:
            a = self.a
            n = min(BLOCK, self.size - k * BLOCK)
            unary = np.unpackbits(a["highs"][a["high_at"][k]:a["high_at"][k + 1]])
            up = np.nonzero(unary)[0][:n] - np.arange(n)
            bits = int(a["width"][k])
            value = up.astype(U) << U(bits)
            if bits:
                low = np.unpackbits(a["lows"][a["low_at"][k]:a["low_at"][k + 1]], count=n * bits).reshape(n, bits)
                for b in range(bits):
                    value |= low[:, b].astype(U) << U(b)
            self._blocks[k] = value + a["first"][k]
        return self._blocks[k]

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at ascending ``places``."""
        out = np.zeros(len(places), U)
        block = places // BLOCK
        edge = np.append(np.nonzero(np.append(True, block[1:] != block[:-1]))[0], len(places)) if len(places) else []
        for a, b in zip(edge, edge[1:], strict=False):
            out[a:b] = self.block(int(block[a]))[places[a:b] % BLOCK]
        return out

    def successor(self, targets: np.ndarray) -> np.ndarray:
        """The place of the first value that isn't below each of the ascending ``targets``."""
        out = np.full(len(targets), self.size, np.int64)
        block = np.maximum(np.searchsorted(self.a["first"], targets, side="left") - 1, 0)
        edge = np.append(np.nonzero(np.append(True, block[1:] != block[:-1]))[0], len(targets)) if len(targets) and self.size else []
        for a, b in zip(edge, edge[1:], strict=False):
            k = int(block[a])
            out[a:b] = k * BLOCK + np.searchsorted(self.block(k), targets[a:b], side="left")
        return out


def write(arrays: dict[str, np.ndarray]) -> bytes:
    """One buffer: the header's length, the header (JSON), the arrays at multiples of 8."""
    head, at = {}, 0
    for name, x in arrays.items():
        head[name] = (str(x.dtype), at, len(x))
        at += -(-x.nbytes // 8) * 8
    told = json.dumps(head).encode()
    told += b" " * (-len(told) % 8)
    return len(told).to_bytes(8, "little") + told + b"".join(x.tobytes() + bytes(-x.nbytes % 8) for x in arrays.values())


def read(buffer) -> dict[str, np.ndarray]:
    """The arrays of such a buffer (bytes or a mapped file), in place."""
    size = int.from_bytes(buffer[:8], "little")
    head = json.loads(bytes(buffer[8:8 + size]))
    return {name: np.frombuffer(buffer, np.dtype(kind), n, 8 + size + at) for name, (kind, at, n) in head.items()}


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a buffer in a local file, mapped into memory."""
    with open(path, "rb") as f:
        return read(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


class Level:
    """The children of the nodes above: pointers to each node's first child, and the children's ids.  A node's ids
    are stored relative to the last value of the node before it, so that the whole level ascends."""

    @staticmethod
    def arrays(name: str, parents: int, parent: np.ndarray, ids: np.ndarray, **data: np.ndarray) -> dict[str, np.ndarray]:
        """Of children sorted by (parent, id); a parent is its place in the level above."""
        ids, count = ids.astype(U), np.bincount(parent, minlength=parents)
        pointer = np.concatenate([[0], np.cumsum(count)])
        last = np.where(count > 0, np.append(ids, U(0))[pointer[1:] - 1] + U(1), U(0))
        base = np.concatenate([np.zeros(1, U), np.cumsum(last, dtype=U)])
        parts = {"pointer": as_sequence(pointer), "ids": as_sequence(ids + base[parent])}
        return {f"{name}.{p}.{k}": v for p, x in parts.items() for k, v in x.items()} | {f"{name}.{k}": v for k, v in data.items()}

    def __init__(self, name: str, arrays: dict[str, np.ndarray]):
        own = {k[len(name) + 1:]: v for k, v in arrays.items() if k.startswith(name + ".")}
        self.pointer, self.ids = (Sequence({k[len(p) + 1:]: v for k, v in own.items() if k.startswith(p + ".")}) for p in ("pointer", "ids"))
        self.data = {k: v for k, v in own.items() if "." not in k}

    def find(self, parent: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The place of each child (parent, id), -1 where there is none; queries ascend by (parent, id), and a parent
        of -1 has no children."""
        out = np.full(len(parent), -1, np.int64)
        asked = np.nonzero(parent >= 0)[0]
        if not len(asked) or not self.ids.size:
            return out
        parent, ids = parent[asked], ids[asked].astype(U)
        node, back = np.unique(parent, return_inverse=True)
        begin, end = self.pointer.at(node).astype(np.int64), self.pointer.at(node + 1).astype(np.int64)
        # a node's ids follow the last value before its first child
        base = np.where(begin > 0, self.ids.at(np.maximum(begin - 1, 0)) + U(1), U(0))
        past = np.where(end > 0, self.ids.at(np.maximum(end - 1, 0)) + U(1), U(0))
        place = self.ids.successor(np.minimum(base[back] + ids, past[back]))
        inside = place < end[back]
        hit = np.zeros(len(place), bool)
        hit[inside] = self.ids.at(place[inside]) == (base[back] + ids)[inside]
        out[asked[hit]] = place[hit]
        return out
