"""License notices by template markup.

A template is a text with regions between ``<<beginOptional>>`` and ``<<endOptional>>`` and
replaceable parts ``<<var;match=number;words=0-2>>`` (``match`` is ``word`` or ``number``).
All templates are compiled into one automaton over words, which accepts a text where the
mandatory wording stands exactly, with any choice of the optional and replaceable regions.
Plain phrases are templates without such regions.

Contract: null is empty; an empty text has no words, no places and empty labels; texts are
read whole; repeated rows are scanned separately; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm.automata import Automaton, determinise, run
from tidegauge.llm.words import MARKS, Words, split

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices in template markup.
TEMPLATES = {
    "gpl-3.0": "licensed under <<beginOptional>>the terms of<<endOptional>> the gnu general public license "
    "<<beginOptional>>as published by the free software foundation either<<endOptional>> version 3",
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-nc": "licensed under <<beginOptional>>a creative commons<<endOptional>> cc by nc <<var;match=number;words=1-2>>",
    "mit-notice": "<<var;match=word;words=1-1>> under <<beginOptional>>the terms of<<endOptional>> the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "<<beginOptional>>and associated documentation files<<endOptional>> <<beginOptional>>the software<<endOptional>> "
    "to deal in the software without restriction",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met",
}

WORD, NUMBER = 0, 1  # symbols of words that no template names
_PART = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var;match=(word|number);words=(\d+)-(\d+)>>|([a-z0-9]+)")


def parse(markup: str) -> list:
    """Words, ``("var", kind, least, most)`` and, for optional regions, nested lists."""
    stack: list[list] = [[]]
    for m in _PART.finditer(markup):
        if m[0] == "<<beginOptional>>":
            stack.append([])
        elif m[0] == "<<endOptional>>":
            region = stack.pop()
            stack[-1].append(region)
        elif m[1]:
            stack[-1].append(("var", m[1], int(m[2]), int(m[3])))
        else:
            stack[-1].append(m[4])
    if len(stack) != 1:
        raise ValueError(f"an optional region is not closed: {markup}")
    return stack[0]


def compile_templates(templates: dict[tuple[str, bool], str]) -> tuple[Automaton, dict[str, int]]:
    """Automaton and the symbols of the words it knows; results are (label, is it a phrase)."""
    moves: list[list[tuple[object, int]]] = []  # by state: what is read (None: nothing), next state
    ends: dict[int, tuple[str, bool]] = {}
    vocabulary: dict[str, int] = {}

    def state() -> int:
        moves.append([])
        return len(moves) - 1

    def chain(parts: list, at: int) -> int:
        for part in parts:
            if isinstance(part, str):
                vocabulary.setdefault(part, len(vocabulary) + 2)
                after = state()
                moves[at].append((part, after))
                at = after
            elif isinstance(part, list):
                end = chain(part, at)
                moves[at].append((None, end))
                at = end
            else:
                _, kind, least, most = part
                last = at
                skips = []
                for k in range(most):
                    if k >= least:
                        skips.append(last)
                    after = state()
                    moves[last].append(((kind,), after))
                    last = after
                for s in skips:
                    moves[s].append((None, last))
                at = last
        return at

    begins = []
    for (label, phrase), markup in templates.items():
        begins.append(state())
        ends[chain(parse(markup), begins[-1])] = (label, phrase)

    def closure(states) -> set[int]:
        seen, todo = set(), list(states)
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for what, y in moves[x] if what is None]
        return seen

    names = {i: w for w, i in vocabulary.items()}

    def step(x: int, symbol: int) -> set[int]:
        number = symbol == NUMBER or names.get(symbol, "").isdigit()
        return closure(
            y
            for what, y in moves[x]
            if what is not None and (what == names.get(symbol) or what == ("word",) or (what == ("number",) and number))
        )

    return determinise(closure(begins), step, ends.get, len(vocabulary) + 2), vocabulary


def symbols(words: Words, vocabulary: dict[str, int]) -> np.ndarray:
    """Symbol of every word. Only words that could be in the vocabulary are looked at."""
    out = np.zeros(len(words.starts), dtype=np.int32)
    if not len(out):
        return out
    first = words.data[words.starts]
    size = words.ends - words.starts
    shape = np.zeros((256, 64), dtype=bool)
    for w in vocabulary:
        shape[ord(w[0]), len(w)] = True
    may = np.flatnonzero(shape[first, np.minimum(size, 63)])
    codes = {w.encode(): i for w, i in vocabulary.items()}
    out[may] = [codes.get(words.text(i), WORD) for i in may]
    # Numbers: words whose bytes are digits throughout.
    digit = np.flatnonzero((first >= 48) & (first <= 57) & (out == WORD))
    out[digit] = [NUMBER if words.text(i).isdigit() else WORD for i in digit]
    return out


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", phrases=None, templates=None) -> DataFrame:
    """One row per document: words, phrase places, labels and score."""
    rules = {(v, True): k for k, v in (phrases or PHRASES).items()} | {(k, False): v for k, v in (templates or TEMPLATES).items()}
    automaton, vocabulary = compile_templates(rules)
    kind = docs.schema[key].dataType.simpleString()
    starts = automaton.table[1] > 0
    schema = f"{key} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in split(batch.column(1), MARKS, lower=True):
                yield _rows(batch.column(0).slice(words.row0, words.rows), words)

    def _rows(ids: pa.Array, words: Words) -> pa.RecordBatch:
        code = symbols(words, vocabulary)
        row = words.row_of()
        end = words.first[1:][row] if len(row) else row
        begin = np.flatnonzero(starts[code])
        if len(begin):  # two symbols at once: most starts end here
            second = np.minimum(begin + 1, len(code) - 1)
            begin = begin[automaton.table[automaton.table[1, code[begin]], code[second]] > 0]
        places: dict[int, list[int]] = {}
        base: dict[int, set[str]] = {}
        named: dict[int, set[str]] = {}
        for index, label in run(automaton, code, begin, end[begin], whole=False):
            for i, found in zip(index, label, strict=True):
                r = int(row[begin[i]])
                for name, phrase in automaton.labels[found]:
                    named.setdefault(r, set()).add(name)
                    if phrase:
                        base.setdefault(r, set()).add(name)
                        places.setdefault(r, []).append(int(begin[i] - words.first[r]))
        n = range(words.rows)
        noticed = [bool(named.get(r, set()) - base.get(r, set())) for r in n]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(np.diff(words.first).astype(np.int64)),
                pa.array([len(places.get(r, ())) for r in n], pa.int64()),
                pa.array([min(places[r]) if r in places else None for r in n], pa.int64()),
                pa.array([max(places[r]) if r in places else None for r in n], pa.int64()),
                pa.array([",".join(sorted(base.get(r, ()))) for r in n], pa.string()),
                pa.array([",".join(sorted(named.get(r, ()))) for r in n], pa.string()),
                pa.array([1.0 if noticed[r] else 0.5 if r in base else 0.0 for r in n], pa.float64()),
            ],
            names=[key, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )

    return docs.select(key, text).mapInArrow(scanned, schema)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every text of ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS t,
    list_filter(range(len(w)), lambda i: w[i+1] = 'gnu' AND w[i+2] = 'general' AND w[i+3] = 'public' AND w[i+4] = 'license') AS gpl,
    list_filter(range(len(w)), lambda i: w[i+1] = 'apache' AND w[i+2] = 'license') AS apache,
    list_filter(range(len(w)), lambda i: w[i+1] = 'cc' AND w[i+2] = 'by') AS cc,
    list_filter(range(len(w)), lambda i: w[i+1] = 'mit' AND w[i+2] = 'license') AS mit
  FROM d
), p AS (
  SELECT *, list_concat(list_concat(gpl, apache), list_concat(cc, mit)) AS hits,
    list_filter([CASE WHEN len(gpl) > 0 THEN 'gpl' END, CASE WHEN len(apache) > 0 THEN 'apache' END,
      CASE WHEN len(cc) > 0 THEN 'cc-by' END, CASE WHEN len(mit) > 0 THEN 'mit' END], lambda x: x IS NOT NULL) AS base,
    list_filter([
      CASE WHEN regexp_matches(t, ' licensed under (the terms of )?the gnu general public license (as published by the free software foundation either )?version 3 ') THEN 'gpl-3.0' END,
      CASE WHEN contains(t, ' licensed under the apache license version 2 0 ') THEN 'apache-2.0' END,
      CASE WHEN regexp_matches(t, ' licensed under (a creative commons )?cc by nc [0-9]+ ') THEN 'cc-by-nc' END,
      CASE WHEN regexp_matches(t, '[^ ] under (the terms of )?the mit license ') THEN 'mit-notice' END,
      CASE WHEN regexp_matches(t, ' permission is hereby granted free of charge to any person obtaining a copy of this software (and associated documentation files )?(the software )?to deal in the software without restriction ') THEN 'mit-grant' END,
      CASE WHEN contains(t, ' redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met ') THEN 'bsd-grant' END
    ], lambda x: x IS NOT NULL) AS notice
  FROM s
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(hits) AS BIGINT) AS n_base,
       CAST(list_min(hits) AS BIGINT) AS first_word, CAST(list_max(hits) AS BIGINT) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_concat(base, notice)), ',') AS labels,
       CAST(CASE WHEN len(notice) > 0 THEN 1.0 WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM p
"""
