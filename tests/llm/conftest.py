import pytest

SOURCES = ["b", "a", None, "c", "a"]


def base_texts():
    """Texts of every awkward kind: (text, how often)."""
    passage = " ".join(f"p{i}" for i in range(50))
    near = [f"w{i}" for i in range(120)]
    return [
        (None, 2), ("", 2), (" \t\n ", 1), ("one", 2), ("one two three four", 2),
        ("Same words here again and again\nSame words here again and again", 1),
        (passage, 3), ("lead in " + passage + " and out", 1), ("x " * 200, 1),
        (" ".join(near), 1), (" ".join(near[:60] + ["CHANGED"] + near[61:]), 1),
        (" ".join(near).upper(), 1), ("line a b c d e\nline b\n\nline a b c d f", 1),
        (" ".join(f"long{i}" for i in range(30_000)), 1), ("été 中文 \U0001f642", 1),
        ("ends in blanks  \n", 1), ("\n\nstarts in blanks", 1),
    ]


@pytest.fixture(scope="session")
def odd_rows():
    rows, i = [], 0
    for text, times in base_texts():
        for _ in range(times):
            rows.append((i, text, SOURCES[i % len(SOURCES)]))
            i += 1
    rows.append(rows[3])             # a repeated row
    rows.append(rows[8])
    rows.append((None, "a row without an id", "a"))
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """Documents with nulls, empty and long texts, ties, repeats and clashing columns."""
    clash = ["id", "th", "g", "n", "limit", "rest", "target", "size", "words", "spans", "score",
             "kept", "length", "start", "node", "component_id", "predicted", "gone", "rank"]
    rows = [(i, t, "en", s, len(t or ""), *["clash"] * len(clash)) for i, t, s in odd_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in clash)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame(
        [], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def as_table(tmp_path):
    """Write frames as the tables of a folder, for queries that read one."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write
