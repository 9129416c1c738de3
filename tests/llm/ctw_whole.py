"""The whole context tree in one process: what the distributed one is held against."""

import math
from collections.abc import Iterator

import numpy as np

from sprout.llm.ctw import DEPTH, byte_sequence, log_gamma, mask, weighted


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of next bytes (..., 256) to zeros and ones at the 255 decisions, by level, then by the bits before."""
    zeros, ones = [], []
    for level in range(8):
        halves = counts.reshape(*counts.shape[:-1], 1 << level, 2, 128 >> level).sum(-1)
        zeros.append(halves[..., 0])
        ones.append(halves[..., 1])
    return np.concatenate(zeros, -1).astype(float), np.concatenate(ones, -1).astype(float)


class Node:
    """KT estimates of the decisions at contexts: ln block probability and probability of a one."""

    def __init__(self, counts: np.ndarray):
        zeros, ones = bit_counts(counts)
        self.block = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1)
        self.one = (ones + 0.5) / (zeros + ones + 1)


def byte_logs(one: np.ndarray) -> np.ndarray:
    """Probabilities of a one at the 255 decisions (..., 255) to log10 probabilities of the 256 bytes."""
    byte = np.arange(256)
    total = np.zeros((*one.shape[:-1], 256))
    for level in range(8):
        p = one[..., (1 << level) - 1 + (byte >> (8 - level))]
        total += np.log10(np.where(byte >> (7 - level) & 1, p, 1 - p))
    return total.astype(np.float32)


class Tree:
    """The nodes of the tree: all contexts of 1 to DEPTH bytes that at least ``least`` windows have.

    A context is an integer, its last byte lowest. The contexts of a node's children that are too rare share one leaf, the
    node's rest, so every window is counted at every depth.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray, least: int):
        byte = code & 0xFF
        self.keys, self.parent = [], []
        counts, rest, inside = [], [], np.zeros(len(code), np.int64)  # inside: a window's node one level up, or -1
        for depth in range(1, DEPTH + 1):
            key, at = np.unique(code >> 8 & mask(depth), return_inverse=True)
            kept = np.bincount(at, n, minlength=len(key)) >= least
            node = np.where(kept, np.cumsum(kept) - 1, -1)[at]
            own = np.zeros((int(kept.sum()), 256), np.int64)
            np.add.at(own, (node[node >= 0], byte[node >= 0]), n[node >= 0])
            lost = (node < 0) & (inside >= 0)  # their windows end at the rest of the node above
            rare = np.zeros((len(counts[-1]) if counts else 1, 256), np.int64)
            np.add.at(rare, (inside[lost], byte[lost]), n[lost])
            above = np.zeros(len(own), np.int64)
            above[node[node >= 0]] = inside[node >= 0]
            self.keys.append(key[kept])
            self.parent.append(above)
            counts.append(own)
            rest.append(rare)
            inside = node
        self.rare = rest[0]  # of the whole branch, if it has no node
        self.nodes = [Node(c) for c in counts]
        self.rests = [Node(c) for c in rest[1:]]
        below, self.weights = self.nodes[-1].block, []
        for d in range(DEPTH - 1, 0, -1):
            children = self.rests[d - 1].block.copy()
            np.add.at(children, self.parent[d], below)
            below, weight = weighted(self.nodes[d - 1].block, children)
            self.weights.insert(0, weight)
        self.counts, self.log = counts[0].sum(0), below.sum(0)

    def rows(self, root: Node, weight: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(depth, context, log10 probabilities of the next byte) of every node, for places at which it is the deepest."""
        done, left = (weight * root.one)[None], (1 - weight)[None]
        for d in range(1, DEPTH + 1):
            done, left = done[self.parent[d - 1]], left[self.parent[d - 1]]
            node = self.nodes[d - 1]
            if d < DEPTH:
                w = self.weights[d - 1]
                done, left = done + left * w * node.one, left * (1 - w)
                ones = done + left * self.rests[d - 1].one
            else:
                ones = done + left * node.one
            for i in range(0, len(ones), 1024):
                for key, logs in zip(self.keys[d - 1][i:i + 1024], byte_logs(ones[i:i + 1024]), strict=True):
                    yield d, int(key), logs.tobytes()


class Model:
    """The nodes' contexts and log10 probabilities of next bytes, the root first, in one process."""

    def __init__(self, depth: np.ndarray, key: np.ndarray, logs: np.ndarray):
        self.depth, self.key, self.logs = depth, key, logs
        self._child = None

    def __getstate__(self):
        return self.depth, self.key, self.logs

    def __setstate__(self, state):
        self.__init__(*state)

    def children(self) -> np.ndarray:
        """Place of the child by node and next older byte; 0, the root, if there is none."""
        place = {(int(d), int(k)): i for i, (d, k) in enumerate(zip(self.depth, self.key, strict=True))}
        child = np.zeros(len(place) * 256, np.int32)
        for (d, k), i in place.items():
            if d:
                child[place[d - 1, k & mask(d - 1)] * 256 + (k >> 8 * (d - 1))] = i
        return child

    def score(self, text: bytes) -> float:
        """log10 probability of a text and its end."""
        if self._child is None:
            self._child, self._table = self.children(), self.logs.reshape(-1)
        total, s, block = 0.0, byte_sequence(text), 1 << 18
        for i in range(DEPTH, len(s), block):
            part = s[i - DEPTH:i + block]
            node = np.zeros(len(part) - DEPTH, np.int64)
            going = np.arange(len(node))
            for d in range(1, DEPTH + 1):
                step = self._child[node[going] * 256 + part[going + (DEPTH - d)]]
                going = going[step > 0]
                node[going] = step[step > 0]
            total += float(self._table[node * 256 + part[DEPTH:]].sum(dtype=np.float64))
        return total
