from collections import defaultdict

import duckdb

from visitlake.llm import linespread as L
from visitlake.llm.queries import SQL, op7_line_spread

SCHEMA = "doc_id long, text string, source string, n_chars long, h1 string, home int"


def brute(rows, limit=L.SITES):
    sites, texts, home = defaultdict(set), defaultdict(set), {}
    for i, t, s, *_ in rows:
        for line in (t or "").split("\n"):
            line = line.strip(L.BLANKS)
            if line:
                sites[line].add(s or "")
                texts[line].add(t)
                if i is not None:
                    home[line] = min(i, home.get(line, i))
    bad = {x for x in sites if min(len(sites[x]), len(texts[x])) >= limit}
    out = []
    for i, t, *_ in rows:
        lines = t.split("\n") if t is not None else []
        left = [x for x in lines if x.strip(L.BLANKS) not in bad or home.get(x.strip(L.BLANKS)) == i and i is not None]
        out.append((i, None if t is None else "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def run(spark, rows):
    got = L.remove_boilerplate(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == [*"doc_id text source n_chars h1 home".split(), "__n_lines", "__n_removed"]
    return sorted(((r.doc_id, r.text, r["__n_lines"], r["__n_removed"]) for r in got.collect()), key=repr)


def row(i, text, source):
    return (i, text, source, 0, "clash", 1)


def test_against_plain_counts(spark):
    footer, short = "All rights reserved.", "Les."
    rows = [row(i, f"own line number {i}\n{short}\n {footer}\t\n", f"s{i % 7}") for i in range(20)]
    rows += [row(100 + i, f"seen on four sites only\nanother own line {i}", f"s{i % 4}") for i in range(40)]
    rows += [row(200 + i, f"seen on five sites now\r\nanother own line {i}", f"s{i % 5}") for i in range(40)]
    rows += [row(300 + i, "a text copied everywhere\nwith its second line", f"s{i}") for i in range(12)]
    rows += [row(400, None, "a"), row(401, "", "a"), row(402, "\n\n", None), row(None, f"x\n{footer}", None), row(3, rows[3][1], "s3"),
             row(500, footer, "s9"), row(501, (footer + "\n") * 20_000 + "the end of the text", "s1")]
    assert run(spark, rows) == brute(rows)


def test_many_sites_are_decided_by_the_sketch(spark):
    rows = [row(i, f"shared by a thousand sites\nthe line of number {i}", f"site{i}") for i in range(1000)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert L.remove_boilerplate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_of_any_name_are_kept(spark):
    names = ["__lines", "__left", "__gone", "__id", "___id", "__n_removed", "__n_lines"]
    rows = [row(i, f"line of its own {i}\nthe very same footer line", f"s{i}")[:4] + tuple(range(i, i + 7)) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    out = L.strip_documents(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r)[4:] for r in out.collect()) == sorted(r[4:] for r in rows)
    assert [len(r.text.split("\n")) for r in out.orderBy("doc_id").collect()] == [2, 1, 1, 1, 1, 1]


def test_stage_updates_the_count(spark):
    rows = [row(i, f"line of its own {i}\nthe very same footer line", f"s{i}") for i in range(6)]
    out = L.strip_documents(spark.createDataFrame(rows, SCHEMA))
    assert {r.doc_id: r.n_chars for r in out.collect()} == {0: 0} | {i: 17 for i in range(1, 6)}


def test_stage_removes_short_lines_by_their_spread(spark):
    rows = [row(i, f"line of its own {i}\nLes.\n\n }} \nfour{i % 4}", f"s{i % 7}") for i in range(28)]
    out = {r.doc_id: r.text for r in L.strip_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    # "four0" and its like stand on all seven sites; blank lines stay.
    assert out == {i: rows[i][1] if i == 0 else f"line of its own {i}\n" + (f"\nfour{i}" if i < 4 else "") for i in range(28)}


def test_query_matches_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    cursor = duck.execute(SQL["op7_line_spread"])
    names = [c[0] for c in cursor.description]
    df = op7_line_spread(spark, sf_dir)
    assert df.columns == names
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_boilerplate_is_stored_in_few_files(spark, files_of):
    rows = [(i, "\n".join([f"footer {k}" for k in range(60)] + [f"own {i}"]), f"s{i}") for i in range(12)]
    files = files_of(L)
    stripped = L.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(r.text == f"own {r.doc_id}" for r in stripped.collect()) == [False] + [True] * 11
    assert len(files) == 2 and files[0] > 10 and files[1] == 1
