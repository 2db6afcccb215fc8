"""Operator 4: token counts by rank-synchronous array merging.

For BPE vocabularies in the tokenizers JSON layout with a word-end suffix: the
text is cut at the special strings (each is one token), normalised, lower-cased
and split into pre-tokens by the file's own pattern; the pre-tokens of a batch
are held as one ragged numpy array of symbol ids.  In every round each sequence
finds its lowest-rank pair and merges all its occurrences (leftmost first where
they overlap), all sequences at once; the symbols that survive are the tokens.
Merging all occurrences in one round is exact because a merge's result only
takes part in merges of higher rank, which is checked when the file is loaded.
For the same reason ranks only rise, so long sequences (unspaced text) are merged
rank by rank from buckets of positions, and only pairs beside a merge are ranked
anew: a round costs what it merges, not the sequence's length.

White space ends every pre-token, so the unit of work is a space-separated piece
and each batch merges its distinct pieces once.  Memory is bounded by a batch.

Defined cases: a null or empty text has no bytes and no tokens; texts of any
length are counted whole; equal rows get equal results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 2048
#: Pieces whose counts a task keeps between batches.
KEPT_PIECES = 500_000
#: Pre-tokens of more symbols are merged from buckets of positions by rank.
LONG_WORD = 256


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 for itself, the others for code points from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Merger:
    """A vocabulary as arrays, and the counting of pieces."""

    def __init__(self, spec: dict):
        import regex

        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(ids.values()) + 1
        self.byte_id = np.array([ids[c] for c in byte_symbols()])
        self.last_byte_id = np.array([ids[c + suffix] for c in byte_symbols()])
        left, right = (np.array([ids[m[i]] for m in merges]) for i in (0, 1))
        made = np.array([ids[a + b] for a, b in merges])
        rank_of = np.full(self.size, -1)
        rank_of[made[::-1]] = np.arange(len(made))[::-1]
        if np.any(np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(made))):
            raise ValueError("a merge needs the result of a later one")
        key = left * self.size + right
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order, made
        (pattern,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(pattern)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")
        self.no_rank = len(made)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
        return np.where(self.key[at] == k, self.rank[at], self.no_rank)

    def count_words(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        seq = np.repeat(np.arange(len(words)), lens)
        sym = self.byte_id[raw]
        ends = np.cumsum(lens)[lens > 0] - 1
        sym[ends] = self.last_byte_id[raw[ends]]
        out = lens.copy()
        long = (lens > LONG_WORD)[seq]
        if long.any():
            out[lens > LONG_WORD] = self._count_long(sym[long], seq[long], len(words))[lens > LONG_WORD]
            sym, seq = sym[~long], seq[~long]
        while len(sym):
            same = seq[1:] == seq[:-1]
            rank = np.full(len(sym), self.no_rank)
            rank[:-1][same] = self._rank(sym[:-1][same], sym[1:][same])
            first = np.flatnonzero(np.r_[True, ~same])
            low = np.minimum.reduceat(rank, first)
            lens = np.diff(np.r_[first, len(seq)])
            on = low < self.no_rank  # the others are done and leave
            hit = (rank == np.repeat(low, lens)) & np.repeat(on, lens)
            # of a run of overlapping occurrences every second one stays
            begins = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
            if len(begins):
                at = np.flatnonzero(hit)
                run = np.searchsorted(begins, at, side="right") - 1
                at = at[(at - begins[run]) % 2 == 0]
                sym[at] = self.made[rank[at]]
                gone = np.zeros(len(sym), bool)
                gone[at + 1] = True
                out -= np.bincount(seq[at], minlength=len(out))
                keep = np.repeat(on, lens) & ~gone
            else:
                keep = np.zeros(len(sym), bool)
            sym, seq = sym[keep], seq[keep]
        return out

    def _count_long(self, sym: np.ndarray, seq: np.ndarray, n_seq: int) -> np.ndarray:
        """Symbols that survive in each sequence; rounds go by rank over all of them."""
        n = len(sym)
        same = seq[1:] == seq[:-1]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[:-1][~same] = n
        after[-1] = n
        before[1:][~same] = -1
        rank, alive = np.full(n, self.no_rank), np.ones(n, bool)
        buckets: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def file(at: np.ndarray) -> None:
            at = at[after[at] < n]
            found = self._rank(sym[at], sym[after[at]])
            rank[at] = found
            order = np.argsort(found, kind="stable")
            order = order[:np.searchsorted(found[order], self.no_rank)]
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for part, r in zip(np.split(at, cuts), found[np.r_[0, cuts]].tolist() if len(at) else (), strict=False):
                if r not in buckets:
                    heapq.heappush(ranks, r)
                buckets.setdefault(r, []).append(part)

        file(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(buckets.pop(r)))
            at = at[rank[at] == r]  # others were merged away or have a new neighbour
            if not len(at):
                continue
            # of a run of overlapping occurrences every second one stays
            first = np.r_[True, after[at[:-1]] != at[1:]]
            begins = np.flatnonzero(first)
            at = at[(np.arange(len(at)) - begins[np.cumsum(first) - 1]) % 2 == 0]
            gone = after[at]
            sym[at], alive[gone], rank[gone] = self.made[r], False, self.no_rank
            rank[at] = self.no_rank
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            left = before[at]
            file(np.unique(np.r_[left[left >= 0], at]))
        return np.bincount(seq[alive], minlength=n_seq)

    def count_pieces(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece of text."""
        import unicodedata

        words, owner, special = [], [], np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            if piece.isascii() and piece.isalpha():  # the common case, one pre-token
                words.append(piece.lower().encode())
                owner.append(i)
                continue
            parts = (piece,)
            if "<" in piece:
                special[i] = len(self.special.findall(piece))
                parts = self.special.split(piece)
            for part in parts:
                for w in self.pattern.findall(lower(unicodedata.normalize("NFC", part))):
                    words.append(w.encode("utf-8", "surrogatepass"))
                    owner.append(i)
        if words:
            special += np.bincount(np.array(owner), weights=self.count_words(words), minlength=len(pieces)).astype(np.int64)
        return special


def lower(text: str) -> str:
    """Lower case letter by letter, without the rule for a sigma at a word's end."""
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    with open(path, encoding="utf-8") as f:
        return Merger(json.load(f))


def count_texts(m: Merger, texts: pa.Array, kept: dict[str, int]) -> np.ndarray:
    """Tokens of each text; ``kept`` remembers pieces between batches."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), " ")
    pieces = pc.dictionary_encode(lists.values.slice(0))
    values = pieces.dictionary.to_pylist()
    new = [p for p in values if p not in kept]
    for at in range(0, len(new), 200_000):  # bounded arrays whatever the batch
        part = new[at:at + 200_000]
        kept.update(zip(part, m.count_pieces(part).tolist(), strict=True))
    by_value = np.fromiter((kept[p] for p in values), np.int64, len(values))
    each = by_value[pieces.indices.to_numpy()]
    total = np.r_[0, np.cumsum(each)]
    offsets = lists.offsets.to_numpy()
    if len(kept) > KEPT_PIECES:
        kept.clear()
    return total[offsets[1:]] - total[offsets[:-1]]


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS) -> DataFrame:
    """id, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row.

    ``tokenizer_path`` must lead to the vocabulary file on every executor."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, kept = merger(tokenizer_path), {}
        for b in batches:
            n = count_texts(m, b.column(1), kept)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"))
