import hashlib
import re

from pyspark.sql import functions as F

from visitlake.llm import secrets as S
from visitlake.llm.queries import op9_secret_ownership

HEX = "0123456789abcdef" * 2
KEY = "AKIA" + "ABCDEFGH1234"
TEXTS = [None, "", 'password = "hunter2hunter2" Token:abc secret=token=abcdefgh12', "API_KEY='abcdefgh' apikey: short", f"x {KEY} y{HEX}z{HEX}00",
         "AKIAAKIA AKIAshort " + KEY, "secret = token: abcdefghij", "paſſword=abcdefghijk to\u212aen=abcdefghijk", "é" * 20 + "passwd:  'a.b/c+d_e='",
         "secret" * 3000 + "=" + "Z9" * 4000, "password=" + HEX, "g" * 100_000 + HEX[:31] + " " + HEX[:32]]


def by_the_letter(text):
    """The contract's patterns as written, without any shortcut."""
    found = []
    word = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def joined(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def digest(spans):
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def test_base_as_the_contract_says():
    for text in TEXTS:
        assert [s[:3] for s in S.base_spans(text or "")] == by_the_letter(text or "")
    assert by_the_letter(TEXTS[6]) == [] and by_the_letter(TEXTS[7]) == []


def scanned(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_live string")
    return S.scan_documents(df, F.col("source"), F.concat_ws("/", "source", "doc_id"), **options).collect()


def test_rows(spark):
    rows = [(i, t, "o", "x") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, "x"), (None, "token=12345678", "p", "x")]
    got = sorted(scanned(spark, rows), key=repr)
    want = sorted(((i, by_the_letter(t or "")) for i, t, _, _ in rows), key=lambda r: repr(r[0]))
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got if r.doc_id is not None) == sorted(
        (i, *(sum(x[1] == k for x in s) for k in range(3)), digest(s)) for i, s in want if i is not None)
    assert scanned(spark, rows[:0]) == [] if rows[:0] else True


def test_ownership_separates_examples_from_live_ones(spark):
    live, example = "Zx81" + "q7" * 8, "EXAMPLEKEY1234567890"
    rows = [(1, f"password={live}", "a", ""), (2, f"bare {live}. here", "b", ""), (3, f"other {live}X", "b", "")]
    rows += [(10 + i, f"secret: {example}", f"o{i}", "") for i in range(5)] + [(20, f"bare {example}", "z", "")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    assert (got[1].n_live, got[1].n_example, got[1].spans) == (1, 0, "assign:0:29")
    assert (got[2].n_live, got[2].spans, got[2].n_assign) == (1, "copy:5:25", 0) and got[3].spans == ""
    assert all((got[10 + i].n_live, got[10 + i].n_example) == (0, 1) for i in range(5)) and got[20].spans == ""


def test_many_repositories_of_one_owner_are_an_example(spark):
    rows = [(i, "token=abcdefgh12345678", "a", "") for i in range(4)]
    assert {r.n_example for r in scanned(spark, rows)} == {1}
    assert {r.n_live for r in scanned(spark, rows, max_repositories=4)} == {1}


def test_bare_copies_of_any_live_value(spark):
    values = ["hunter2x", "onlyletters", "20481632", "mixed1234567", "c2VjcmV0IHZhbHVlIDE=", "cGFkZGVkIHZhbHVlcw==", "Long1" * 10]
    rows = [(i, f"password={v}", "a", "") for i, v in enumerate(values)]
    rows += [(100 + i, f"one {v} and {v}. no x{v}", "b", "") for i, v in enumerate(values)]
    # Owned by two under one normal form, so no copies; nothing below eight characters.
    rows += [(200, "token: stopped12.", "a", ""), (201, "token: stopped12", "b", ""), (202, "bare stopped12", "c", ""), (203, "hunter2 xhunter2x", "c", "")]
    got = {r.doc_id: r for r in scanned(spark, rows)}
    for i, v in enumerate(values):
        n, bare = len(v), len(v.rstrip("="))
        assert got[i].n_live == 1 and got[100 + i].n_live == 2
        assert got[100 + i].spans == f"copy:4:{4 + bare},copy:{9 + n}:{9 + n + bare}"
    assert got[202].spans == got[203].spans == "" and got[200].n_example == got[201].n_example == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.scan_documents(df, F.lit("a"), F.lit("b")).count() == 0


def test_query_on_whole_documents(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op9_secret_ownership(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.base_sha256) for r in got) == sorted((i, digest(by_the_letter(t))) for i, t in texts.items())
    for r in got:
        base = set(joined(by_the_letter(texts[r.doc_id])).split(","))
        assert base - {""} <= set(r.spans.split(","))
