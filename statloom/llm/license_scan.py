"""Licences in texts: phrases, and text blocks that contain enough of a licence's words.

Every block is compared with every template by an exact set-similarity join. Tokens are ordered by the
number of documents that hold them, rarest first. A block that shares ``need`` of a template's k tokens
must hold one of the template's k - need + 1 rarest (prefix filter), must have ``need`` tokens (length
filter), and behind the first shared token there must be enough left on both sides (positional filter).
Only blocks that pass are counted in full.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.shared import WORD_BYTES, map_pieces

#: Share of a template's distinct words that a block has to hold.
THRESHOLD = 0.8
#: Least words of one block. Longer paragraphs are read in windows that overlap by half; a window is at least
#: twice as long as the template looked for, so a copy of it stands whole in one window wherever it begins.
BLOCK_WORDS = 240

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# The notices that public licences ask to be put into files.
TEMPLATES = {
    "text-mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the Software), to deal in the Software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the Software",
    "text-bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                "provided that the following conditions are met",
    "text-apache-2.0": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
                       "except in compliance with the License. You may obtain a copy of the License at",
    "text-gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation",
    "text-mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
                    "of the MPL was not distributed with this file, You can obtain one at",
    "text-isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                "in all copies",
    "text-cc-by": "This work is licensed under a Creative Commons Attribution International License",
    "text-cc-by-sa": "This work is licensed under a Creative Commons Attribution ShareAlike International License",
    "text-unlicense": "This is free and unencumbered software released into the public domain",
}


def words(text: bytes) -> list[bytes]:
    return re.findall(WORD_BYTES, text.lower())


def template_tokens(templates: dict[str, str]) -> dict[str, frozenset[bytes]]:
    return {name: frozenset(words(text.encode())) for name, text in templates.items()}


def token_documents(docs: DataFrame, text_col: str, tokens: set[bytes]) -> dict[bytes, int]:
    """In how many documents each token of the templates stands, over all documents."""
    listed = sorted(tokens)

    def run(batches):
        wanted, place = frozenset(listed), {t: k for k, t in enumerate(listed)}
        total = np.zeros(len(listed), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for token in wanted.intersection(words((text or "").encode())):
                    total[place[token]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(listed))), pa.array(total)], names=["token", "n"])

    counted = docs.select(text_col).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n"))
    counts = dict.fromkeys(listed, 0)
    counts.update({listed[k]: n for k, n in counted.collect()})  # one row per token of a template
    return counts


class Index:
    """Templates by the tokens of their prefixes."""

    def __init__(self, templates: dict[str, str], counts: dict[bytes, int], threshold: float):
        self.tokens = template_tokens(templates)
        ranked = sorted(counts, key=lambda t: (counts[t], t))
        self.rank = {t: k for k, t in enumerate(ranked)}
        self.order = {name: sorted(held, key=self.rank.__getitem__) for name, held in self.tokens.items()}
        self.need = {name: max(1, math.ceil(threshold * len(held) - 1e-9)) for name, held in self.tokens.items()}
        self.by_token: dict[bytes, list[tuple[str, int]]] = {}
        for name, order in self.order.items():
            for at, token in enumerate(order[: len(order) - self.need[name] + 1]):
                self.by_token.setdefault(token, []).append((name, at))
        self.prefix = frozenset(self.by_token)

    def matches(self, block: set[bytes]) -> dict[str, float]:
        """The templates whose threshold the block meets, with the share it holds."""
        held = sorted(self.rank.keys() & block, key=self.rank.__getitem__)
        tried, found = set(), {}
        for at, token in enumerate(held):
            for name, place in self.by_token.get(token, ()):
                if name in tried:
                    continue
                tried.add(name)  # this is the first shared token, in the common order
                need = self.need[name]
                if len(held) < need or min(len(self.order[name]) - place, len(held) - at) < need:
                    continue
                shared = len(self.tokens[name] & block)
                if shared >= need:
                    found[name] = shared / len(self.tokens[name])
        return found


def indexes(templates: dict[str, str], counts: dict[bytes, int], threshold: float) -> dict[int, Index]:
    """An index per length of window, of the templates that are looked for in windows of that length."""
    groups: dict[int, dict[str, str]] = {}
    for name, text in templates.items():
        groups.setdefault(max(BLOCK_WORDS, 2 * len(words(text.encode()))), {})[name] = text
    return {most: Index(some, {t: counts[t] for held in template_tokens(some).values() for t in held}, threshold)
            for most, some in groups.items()}


def blocks(text: bytes, most: int = BLOCK_WORDS):
    """The words of each paragraph (blank lines part them); long ones in windows overlapping by half."""
    for _, held in placed_blocks(text, most):
        yield held


def placed_blocks(text: bytes, most: int = BLOCK_WORDS):
    """The same, each after the place of its first word in the text."""
    start = 0
    for part in re.split(rb"\n[\x20\t\r]*\n", text):
        held = words(part)
        for at in range(0, max(1, len(held) - most // 2), most // 2):
            yield start + at, held[at:at + most]
        start += len(held)


def joined(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Blocks (template, first word, last word, share) by place; windows of one template that overlap are one,
    with the best of their shares."""
    made: list[tuple[str, int, int, float]] = []
    for name, first, last, share in sorted(found):
        if made and made[-1][0] == name and first <= made[-1][2]:
            _, low, high, best = made[-1]
            made[-1] = (name, low, max(high, last), max(best, share))
        else:
            made.append((name, first, last, share))
    return sorted(made, key=lambda m: (m[1], m[2], m[0]))


def phrase_places(held: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of every place where a phrase's words follow each other."""
    places = []
    for phrase, label in phrases.items():
        wanted = phrase.encode().split(b" ")
        at = -1
        while True:
            try:
                at = held.index(wanted[0], at + 1)
            except ValueError:
                break
            if held[at:at + len(wanted)] == wanted:
                places.append((at, label))
    return places


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
         phrases: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: n_words, places (first word and label of each phrase), matches (template and best share held),
    blocks (template, first and last word and share held of every block that meets the threshold).

    A copy of a template is found wherever it stands in a paragraph, however long both are. Null and empty texts
    have no words and no finds. Texts are read whole, in one pass of one task for every length of window;
    repeated rows are read each; templates of equal words are all found; other columns are left out.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    kind = docs.schema[id_col].dataType.simpleString()
    counts = token_documents(docs, text_col, set().union(*template_tokens(templates).values()))
    by_window = indexes(templates, counts, threshold)
    starts = {p.encode().split(b" ")[0] for p in phrases}

    def work(columns: dict[str, list]) -> dict:
        n_words, places, matches, found = [], [], [], []
        for text in columns["text"]:
            raw = (text or "").encode()
            held = words(raw)
            own = set(held)
            n_words.append(len(held))
            places.append([{"word": at, "label": label} for at, label in phrase_places(held, phrases)]
                          if own & starts else [])
            met: list[tuple[str, int, int, float]] = []
            for most, index in by_window.items():
                if own & index.prefix and index.matches(own):
                    met += [(name, at, at + len(block) - 1, share) for at, block in placed_blocks(raw, most)
                            for name, share in index.matches(set(block)).items()]
            met = joined(met)
            best: dict[str, float] = {}
            for name, _, _, share in met:
                best[name] = max(share, best.get(name, 0.0))
            found.append([dict(zip(("label", "first", "last", "share"), m)) for m in met])
            matches.append([{"label": name, "share": share} for name, share in sorted(best.items())])
        return {"id": columns["id"], "n_words": n_words, "places": places, "matches": matches, "blocks": found}

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"id {kind}, n_words long, places array<struct<word:long,label:string>>, "
              "matches array<struct<label:string,share:double>>, "
              "blocks array<struct<label:string,first:long,last:long,share:double>>")
    return map_pieces(rows, schema, work).withColumnRenamed("id", id_col)
