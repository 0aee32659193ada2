from __future__ import annotations

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, _key long, kept boolean"
PROSE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n: int, seed: int = 0) -> str:
    """``n`` words that hardly repeat in sequence."""
    x, out = seed * 7919 + 13, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(PROSE[x // 65536 % len(PROSE)] + str(x // 97 % 10))
    return " ".join(out)


def row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None if text is None else len(text), "clash", "clash", 1, True)


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash."""
    base = prose(60, 1)
    rows = [
        row(1, base),
        row(2, base.upper()),
        row(3, base),
        row(4, base + " " + prose(3, 9)),
        row(5, None),
        row(6, ""),
        row(7, " \n\t "),
        row(8, "one"),
        row(9, "One two"),
        row(10, prose(9000, 3)),
        row(11, prose(40, 5) + " " + prose(50, 1)),
        row(12, "same word " * 80),
        row(13, prose(20, 6)),
        row(14, prose(20, 6) + " more"),
        row(None, prose(45, 7)),
        row(None, None),
        row(15, "Ünïcode ñandú " + prose(44, 8), None, None),
        row(16, "tail", None, None),
    ]
    return spark.createDataFrame(rows + rows[2:4] + rows[4:5] + rows[13:14], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small():
    """The small given tables."""
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def in_duckdb(tmp_path_factory):
    """Run SQL over a DataFrame as the table ``documents``."""

    def run(df, sql):
        con = duckdb.connect()
        rows = df.select("doc_id", "text").toArrow()
        con.register("documents", rows)
        query = con.execute(sql)
        names = [d[0] for d in query.description]
        return names, sorted(query.fetchall(), key=repr)

    return run
