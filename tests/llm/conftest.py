"""Edge tables of the training-data operators, written as a table folder."""

import tempfile

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, n_removed string, own string, _row string, _number string, _row_key string, number string"
LONG = " ".join(f"word{i * 7919 % 4001}" for i in range(60_000))
COPY = "One passage that is copied, with enough words to make a few shingles. It has a second sentence too. And here is a third one for spans."


X = "m", "c", "a", "f"


def _docs(rows):
    return [(i, t, l, s, None if t is None else len(t), "r", "s", "x", "o", "p", "q", "k", "n") for i, t, l, s in rows]


EDGE_DOCS = _docs([
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \t\n ", "en", None), (4, "word", "en", "a"), (5, LONG, "en", "a"),
    (6, COPY, "en", "a"), (7, COPY, "de", "b"), (7, COPY, "de", "b"), (None, COPY, None, None), (None, None, None, None),
    (8, "...!!! 123 ###", "en", "a"), (9, "naïve café \U0001F600 \x00 日本語のテキスト", "ja", "a"), (10, "word", "en", "a"),
])


@pytest.fixture(scope="session")
def folders(spark):
    """(edge, empty): folders of the five tables these operators read."""
    out = []
    for full in (True, False):
        path = tempfile.mkdtemp(prefix="skyledger-edge-")
        tables = {
            "documents": (EDGE_DOCS, DOCS),
            "labels": ([(1, 1, 1), (4, 0, 0), (4, 0, 0), (5, None, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int"),
            "embeddings": ([(0, [0.5, -0.25]), (50, [1.0, 0.0]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (3, None),
                            (4, [None, 1.0]), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (100, None)],
                           "vec_id long, embedding array<float>"),
            "pages": ([(1, None, "h"), (2, "", None), (3, "no scheme/path", ""), (4, "HTTP://A.Example.NET/en/x?q#f", "h"),
                       (5, "http://net/en/", "h"), (6, "x://notexample.com/de/1", "h"), (7, "x://example.com/de/1", "h"),
                       (7, "x://example.com/de/1", "h"), (None, "http://b.org/fr/#/x", "h"), (8, "http://" + "a" * 50_000, "h"),
                       (9, "x://sub.example.net/de/", "h"), (10, "://org?a", "h")], "page_id long, url string, html string"),
            "conversations": ([(1, 0, None, None, *X), (1, 0, "user", "Same turn.", *X), (1, 0, "user", "Same turn.", *X), (1, 2, "assistant", LONG, *X),
                               (2, None, "user", "No turn.", *X), (2, None, "tool", " \t", *X), (2, 9, "system", "Late", *X), (2, 3, "", "", *X),
                               (None, None, None, None, *X), (None, 1, "user", "Hi!", *X), (3, 5, "user", "\u00a0", *X),
                               *[(5, i, "user" if i % 2 else "assistant", f"Turn {i} of many.", *X) for i in range(700)]],
                              "conv_id long, turn long, role string, text string, mid string, copy string, audit string, fault string"),
            "benchmark": ([("b1", None), ("b2", ""), ("b3", "second Sentence too"), (None, "passage that is copied"),
                           ("b3", "second sentence too"), ("b4", COPY)], "item_id string, text string"),
        }
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows if full else [], schema).write.parquet(f"{path}/{name}.parquet")
        out.append(path)
    return tuple(out)
