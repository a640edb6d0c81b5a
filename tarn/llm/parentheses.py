"""Trees as balanced parentheses: a node opens, its children follow, it closes.

The excess at a place is the number of nodes open after it. Blocks keep their
least and greatest excess, so the close of a node, the next place with one less,
is looked for in blocks that reach it and nowhere else. What a subtree sums up
lies between open and close, and is the difference of two cumulative values.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256


class Parentheses:
    """A forest from the parent of each node, -1 for roots; parents come first."""

    def __init__(self, parents: list[int]):
        bits, self.opens, self.order = self._written(parents)
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        cuts = np.arange(0, len(bits), BLOCK)
        self.least = np.minimum.reduceat(self.excess, cuts) if len(bits) else self.excess
        self.most = np.maximum.reduceat(self.excess, cuts) if len(bits) else self.excess
        # Opens before each place, and "()" pairs that open before it.
        self.rank = np.concatenate(([0], np.cumsum(bits)))
        self.pair = np.zeros(len(bits), bool)
        self.pair[:-1] = bits[:-1] & ~bits[1:]
        self.pair_rank = np.concatenate(([0], np.cumsum(self.pair)))

    @staticmethod
    def _written(parents: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bits, the place where each node opens, and the nodes in that order."""
        children: list[list[int]] = [[] for _ in parents]
        open_next = []
        for node, parent in enumerate(parents):
            (open_next if parent < 0 else children[parent]).append(node)
        bits, order = np.zeros(2 * len(parents), bool), []
        opens = np.zeros(len(parents), np.int64)
        stack = open_next[::-1]
        place = 0
        while stack:
            node = stack.pop()
            if node >= 0:
                bits[place] = True
                opens[node] = place
                order.append(node)
                # A node's complement on the stack closes it.
                stack.append(~node)
                stack.extend(reversed(children[node]))
            place += 1
        return bits, opens, np.array(order, np.int64)

    def find_close(self, place: int) -> int:
        """Where the node that opens at ``place`` closes."""
        if self.pair[place]:
            return place + 1
        sought = self.excess[place] - 1
        block = place // BLOCK
        found = self._in_block(block, place + 1, sought)
        if found < 0:
            reach = (self.least[block + 1 :] <= sought) & (self.most[block + 1 :] >= sought)
            block += 1 + int(reach.argmax())
            found = self._in_block(block, block * BLOCK, sought)
        return found

    def _in_block(self, block: int, start: int, sought: int) -> int:
        hits = self.excess[start : (block + 1) * BLOCK] == sought
        return start + int(hits.argmax()) if hits.any() else -1

    def closes(self) -> np.ndarray:
        """Where each node closes, by node."""
        return np.array([self.find_close(place) for place in self.opens.tolist()], np.int64)

    def sums(self, closes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Per node, the weights of its subtree, itself included."""
        total = np.concatenate(([0], np.cumsum(weights[self.order])))
        return total[self.rank[closes]] - total[self.rank[self.opens]]

    def leaves(self, closes: np.ndarray) -> np.ndarray:
        """Per node, the "()" pairs of its subtree."""
        return self.pair_rank[closes] - self.pair_rank[self.opens]
