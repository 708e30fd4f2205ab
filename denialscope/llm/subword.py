"""Subword lattices of many words at once.

A word is ``▁`` and its characters. Every piece of the vocabulary that occurs
in it is an edge; a character without a piece is an edge spelt by its byte
pieces. All words of one length are walked together, position by position.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACE = "▁"
CELLS = 1 << 21  # table cells held at a time
_P = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by length as sorted rolling hashes, and their prior weights."""

    def __init__(self, model_file: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.size = n
        self.bytes = np.full(256, -1, np.int64)
        normal = []
        for i in range(n):
            if sp.is_byte(i):
                self.bytes[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        if (self.bytes < 0).any():
            raise ValueError(f"{model_file} has no byte pieces to spell unknown characters")
        score = np.array([sp.get_score(i) for i in range(n)])
        #: Prior weights from the vocabulary's own scores: log probabilities,
        #: or, where they are the negated ranks of merges, Zipf weights.
        ranked = score[normal].min() < -1000
        weight = np.zeros(n)
        weight[normal] = 1.0 / (2.7 - score[normal]) if ranked else np.exp(score[normal])
        weight[self.bytes[self.bytes >= 0]] = weight[normal].min()
        self.prior = weight / weight.sum()
        self.usable = weight > 0
        by: dict[int, list] = {}
        for i in normal:
            c = np.frombuffer(sp.id_to_piece(i).encode("utf-32-le"), np.uint32)
            by.setdefault(len(c), []).append((int(self.hash(c[None, :])[0]), i))
        self.longest = max(by, default=1)
        self.by_length = {}
        for k, pairs in by.items():
            pairs.sort()
            self.by_length[k] = np.array([h for h, _ in pairs], np.uint64), np.array([i for _, i in pairs], np.int64)

    @staticmethod
    def hash(c: np.ndarray) -> np.ndarray:
        """Rolling hash of every row of a matrix of characters."""
        h = np.zeros(c.shape[0], np.uint64)
        for k in range(c.shape[1]):
            h = h * _P + (c[:, k].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        return h

    def edges(self, chars: np.ndarray) -> list[list[np.ndarray | None]]:
        """edges[end][length - 1]: piece ids, -1 where there is none, of the
        substring of that length that ends at ``end``."""
        n, size = chars.shape
        out: list[list] = [[None] * min(self.longest, e) for e in range(size + 1)]
        mixed = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        for s in range(size):
            h = np.zeros(n, np.uint64)
            for k in range(1, min(self.longest, size - s) + 1):
                h = h * _P + mixed[:, s + k - 1]
                table = self.by_length.get(k)
                if table is None:
                    continue
                at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
                ids = np.where(table[0][at] == h, table[1][at], -1)
                if k == 1 or (ids >= 0).any():
                    out[s + k][k - 1] = ids
        return out


@lru_cache(maxsize=2)
def vocabulary(tokenizer: str) -> Vocabulary:
    import os
    if not os.path.isabs(tokenizer):
        import public_tokenizers
        tokenizer = str(public_tokenizers.path(tokenizer))
    return Vocabulary(tokenizer)


def _char_bytes(c: int) -> bytes:
    return chr(c).encode("utf-8", "replace")


class Lattice:
    """Forward and backward recursions with given log probabilities (natural
    logarithms) of the pieces."""

    def __init__(self, vocab: Vocabulary, log_p: np.ndarray):
        self.vocab, self.log_p = vocab, log_p
        self.padded = np.append(log_p, -np.inf)  # index -1: no edge

    def groups(self, words: list[str]):
        """(positions in ``words``, characters) of equal-length words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            step = max(1, CELLS // int(size) // min(int(size), self.vocab.longest))
            for k in range(0, len(at), step):
                part = at[k:k + step]
                text = "".join([SPACE + words[i] for i in part])
                yield part, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), size)

    def weights(self, chars: np.ndarray, edges: list) -> list:
        """Log weights of the edges, byte spellings included."""
        out = []
        for e, row in enumerate(edges):
            got = [None if ids is None else self.padded[ids] for ids in row]
            if e:
                lone = row[0] < 0 if row[0] is not None else np.ones(len(chars), bool)
                if lone.any():
                    w = got[0].copy() if got[0] is not None else np.full(len(chars), -np.inf)
                    for c in np.unique(chars[lone, e - 1]):
                        w[lone & (chars[:, e - 1] == c)] = sum(self.log_p[self.vocab.bytes[b]] for b in _char_bytes(int(c)))
                    got[0] = w
            out.append(got)
        return out

    @staticmethod
    def forward(weights: list, n: int) -> np.ndarray:
        alpha = np.full((len(weights), n), -np.inf)
        alpha[0] = 0
        for e in range(1, len(weights)):
            parts = np.array([alpha[e - k - 1] + w for k, w in enumerate(weights[e]) if w is not None])
            top = parts.max(axis=0)
            alpha[e] = top + np.log(np.exp(parts - top).sum(axis=0))
        return alpha

    def log_probability(self, words: list[str]) -> np.ndarray:
        """Marginal log probability of each word over all segmentations."""
        out = np.zeros(len(words))
        for at, chars in self.groups(words):
            out[at] = self.forward(self.weights(chars, self.vocab.edges(chars)), len(chars))[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece in ``counts`` copies of the words."""
        use = np.zeros(self.vocab.size + 1)
        for at, chars in self.groups(words):
            edges = self.vocab.edges(chars)
            weights = self.weights(chars, edges)
            n, size = chars.shape
            alpha = self.forward(weights, n)
            beta = np.full((size + 1, n), -np.inf)
            beta[size] = 0
            for e in range(size, 0, -1):
                for k, w in enumerate(weights[e]):
                    if w is not None:
                        s = e - k - 1
                        beta[s] = np.logaddexp(beta[s], w + beta[e])
            c = counts[at]
            for e in range(1, size + 1):
                for k, w in enumerate(weights[e]):
                    if w is None:
                        continue
                    p = c * np.exp(alpha[e - k - 1] + w + beta[e] - alpha[size])
                    ids = edges[e][k]
                    if ids is not None:
                        use += np.bincount(np.where(ids < 0, self.vocab.size, ids), p, len(use))
                    if k == 0:
                        lone = np.ones(n, bool) if ids is None else ids < 0
                        for x in np.unique(chars[lone, e - 1]):
                            total = p[lone & (chars[:, e - 1] == x)].sum()
                            for b in _char_bytes(int(x)):
                                use[self.vocab.bytes[b]] += total
        return use[:-1]
