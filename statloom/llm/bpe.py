"""BPE encoding and decoding that encodes repeated passages once.

A text is cut where a rolling hash of the characters before a white space says so. The same passage
is therefore cut alike wherever it stands, and a chunk met before (in any document the worker has
seen) is taken from a bounded cache with its ids. A cut is kept only if encoding the words on both
sides of it together gives the ids of encoding them apart; otherwise the two chunks are joined and
encoded anew, until all joins agree.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import kept_in_worker, map_pieces

#: Characters under the rolling hash; a cut where the top bits of the hash are zero.
WINDOW, CUT_BITS = 16, 7
#: Word pieces and chunks that a worker keeps.
WORDS_KEPT, CHUNKS_KEPT = 300_000, 12_000
#: Texts that Unicode normalisation leaves alone and whose letters have one lower case, up to Latin Extended-A.
_PLAIN = re.compile("[\t\n\x20-\x7e\xa1-\u012f\u0131-\u017f]*")
_BLANK = re.compile("[ \n\t]+")
_FIRST = re.compile(r"\s*\S*")
_BASE = 0x9E3779B97F4A7C15 | 1


def cuts(text: str) -> list[int]:
    """Places where chunks end: before a white space, where the hash of the characters before it fits."""
    n = len(text)
    if n <= WINDOW:
        return [n] if n else []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = np.flatnonzero((codes == 32) | (codes == 10))
    space = space[space >= WINDOW]
    hashed = np.zeros(len(space), np.uint64)
    for step in range(WINDOW):
        hashed = hashed * np.uint64(_BASE) + codes[space - WINDOW + step]
    hashed ^= hashed >> np.uint64(31)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    at = space[hashed >> np.uint64(64 - CUT_BITS) == 0]
    return [*at.tolist(), n]


class Known(dict):
    """The ids of word pieces; a new piece is merged by the library, and kept while there is room."""

    def __init__(self, merge, room: int):
        super().__init__()
        self.merge, self.room = merge, room

    def __missing__(self, piece: str) -> bytes:
        tokens = self.merge(piece)
        ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(piece) <= 48:
            if len(self) >= self.room:  # drop the oldest tenth, which may since have grown rare
                for old in [*islice(self, self.room // 10)]:
                    del self[old]
            self[piece] = ids
        return ids


class Encoder:
    """Encodes with one tokenizer file; keeps the ids of words and of chunks within bounds."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chunks: dict[str, bytes] = {}
        self.joins: dict[str, bool] = {}
        self.reused = self.encoded = 0
        self.pattern = self._pattern()
        self.pieces = Known(self._merged, WORDS_KEPT)

    def _pattern(self):
        """The expression that splits words, if the file's steps before the merges are those known here."""
        import json
        spec = json.loads(self.tok.to_str())
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        known = (
            [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": "\\s+"}
            and [x["type"] for x in split] == ["Split", "ByteLevel"]
            and "Regex" in split[0]["pattern"] and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
        )
        if not known:
            return None
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        codes = range(0x21, 0x180)
        self.letters = {c: "".join(part for part, _ in level.pre_tokenize_str(chr(c))) for c in codes}
        self.special = [t.content[:2] for t in self.tok.get_added_tokens_decoder().values()]
        # The two classes of the pattern, spelled out for the characters of plain texts.
        kinds = {k: "".join(chr(c) for c in codes if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        pattern = split[0]["pattern"]["Regex"]
        return re.compile(pattern.replace("\\p{L}", kinds["L"]).replace("\\p{N}", kinds["N"]))

    def _merged(self, piece: str):
        return self.tok.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))

    def raw(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text, as little-endian 32-bit numbers."""
        made = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def by_words(self, texts: list[str]) -> list[bytes]:
        """The ids of each text: plain words by the file's pattern and kept pieces, others by the library."""
        if self.pattern is None:
            return self.raw(texts)
        get, find, odd = self.pieces.__getitem__, self.pattern.findall, []

        def plain(part: str):
            return _PLAIN.fullmatch(part) and not any(x in part for x in self.special)

        def ids(part: str) -> bytes:
            return b"".join(map(get, find(part.lower())))

        # White space reaches no token and no step before the merges looks across it.
        split = [[t] if plain(t) else [w for w in _BLANK.split(t) if w] for t in texts]
        made: list[list[bytes]] = []
        for parts in split:
            made.append([])
            for part in parts:
                if plain(part):
                    made[-1].append(ids(part))
                else:
                    odd.append((made[-1], len(made[-1]), part))
                    made[-1].append(b"")
        for (where, k, _), got in zip(odd, self.raw([part for *_, part in odd])):
            where[k] = got
        return [b"".join(parts) for parts in made]

    def _agree(self, pairs: set[tuple[str, str]]) -> dict[tuple[str, str], bool]:
        """For the words on both sides of a cut: whether they encode alike together and apart."""
        known = self.joins
        if len(known) > 50_000:
            known.clear()
        fresh = [p for p in pairs if p not in known]
        if fresh:
            together = self.raw([a + b for a, b in fresh])
            left, right = self.by_words([a for a, _ in fresh]), self.by_words([b for _, b in fresh])
            for pair, whole, a, b in zip(fresh, together, left, right):
                known[pair] = whole == a + b
        return {p: known[p] for p in pairs}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of whole texts, exactly as the library encodes them."""
        pieces = []
        for text in texts:
            start, parts = 0, []
            for end in cuts(text):
                parts.append(text[start:end])
                start = end
            pieces.append(parts)

        def edge(a: str, b: str) -> tuple[str, str]:
            # The last word of a with the white space after it; the white space b begins with and a word.
            word = a.rstrip()
            return a[max(word.rfind(" "), word.rfind("\n")) + 1:], _FIRST.match(b).group()

        while True:
            doubt = {edge(a, b) for parts in pieces for a, b in zip(parts, parts[1:])}
            agreed = self._agree(doubt)
            if all(agreed.values()):
                break
            for k, parts in enumerate(pieces):
                joined: list[str] = []
                for part in parts:
                    if joined and not agreed.get(edge(joined[-1], part), False):
                        joined[-1] += part
                    else:
                        joined.append(part)
                pieces[k] = joined
        if len(self.chunks) > CHUNKS_KEPT:
            self.chunks = {}
        wanted = [p for parts in pieces for p in parts]
        fresh = list({p for p in wanted if p not in self.chunks})
        self.encoded += len(fresh)
        self.reused += len(wanted) - len(fresh)
        found = dict(zip(fresh, self.by_words(fresh)))
        for chunk, ids in found.items():
            if len(chunk) <= 4096:
                self.chunks[chunk] = ids
        get = lambda p: found[p] if p in found else self.chunks[p]
        return [b"".join(map(get, parts)) for parts in pieces]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The library's text of each list of ids, special tokens kept."""
        if self.tok.decoder is not None:
            return self.tok.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)
        table = kept_in_worker(("names", id(self)), lambda: np.array(
            [self.tok.id_to_token(k) or "" for k in range(self.tok.get_vocab_size())], object))
        return [" ".join(table[i].tolist()) for i in ids]


def encoder(path: str) -> Encoder:
    return kept_in_worker(("bpe", path), lambda: Encoder(path))


def id_lists(blobs: list[bytes]) -> pa.Array:
    values = np.frombuffer(b"".join(blobs), "<i4")
    offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ids`` (array<int>) of every text, and ``decoded``, the text the ids stand for.

    One row per input row: ``id_col``, ids, decoded. A null text counts as empty, and an empty one has
    no ids and an empty text. Other columns are left out, so their names cannot clash; repeated rows
    and ids are encoded each. Texts of any length are encoded whole, in one task: there is no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(columns: dict[str, list]) -> dict:
        enc = encoder(path)
        blobs = enc.encode([t or "" for t in columns["text"]])
        return {
            "id": columns["id"], "ids": id_lists(blobs),
            "decoded": enc.decode([np.frombuffer(b, "<u4") for b in blobs]),
        }

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    made = map_pieces(rows, f"id {kind}, ids array<int>, decoded string", work)
    return made.withColumnRenamed("id", id_col)
