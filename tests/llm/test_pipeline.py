import random

import corpus_pipeline as P
import public_tokenizers
import tiktoken

from visitlake.llm import bpe, toxicity
from visitlake.llm import latent as L
from tests.llm.test_hyperminhash import brute as near_duplicates
from tests.llm.test_linespread import brute as boilerplate


def test_stages_against_plain_python(spark, tmp_path):
    """Every stage's rows are those that plain Python makes of the stage before it."""
    rng = random.Random(3)
    texts = []
    for i in range(160):
        lines = [" ".join(f"w{rng.randrange(900)}" for _ in range(12)) for _ in range(6)]
        if i % 4 == 0:
            lines.append("all rights reserved by the owner")
        if i % 5 == 0:
            lines[1] = lines[1] + " you idiot you moron you idiot"
        texts.append("\n".join(lines))
    texts += [texts[1], texts[2] + " more", texts[3].replace("\n", " ")]
    items = [" ".join(f"q{rng.randrange(900)}" for _ in range(25)) for _ in range(3)]
    texts[6] += "\n" + items[0]
    texts[11] += "\n" + items[1] + "\nand so on"
    rows = [(i, t, "en", f"s{i % 8}", len(t)) for i, t in enumerate(texts)] + [(500, "", "en", "s1", 0), (501, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for _, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, folder))
        kept.append(sorted(map(tuple, docs.collect()), key=repr))
        assert stage is P.STAGES[-1][1] or docs.columns == [c.split()[0] for c in schema.split(", ")]
    clean, lines, single, unleaked, ids = kept
    assert {r[0] for r in clean} == {r[0] for r in rows if r[0] >= 160 or r[0] % 5}
    want = boilerplate([(r[0], r[1], r[3]) for r in clean])
    assert sorted(((r[0], r[1]) for r in lines), key=repr) == sorted(((w[0], w[1]) for w in want), key=repr)
    assert all(r[4] == (len(r[1]) if r[1] is not None else None) for r in lines)
    stays = {i for i, _, _, kept in near_duplicates([(r[0], r[1]) for r in lines], share=80) if kept}
    assert {r[0] for r in single} == stays and len(single) == len(stays) < len(lines)
    held = {r[0] for r in single for i in items if " ".join(L.words_of(i)) in " ".join(L.words_of(r[1]))}
    assert {r[0] for r in unleaked} == stays - held and len(held) == 2
    encoder = bpe.encoder_for(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})
    assert sorted((r[0], r[4]) for r in ids) == sorted((r[0], library.encode_ordinary(r[1] or "")) for r in unleaked)
    assert toxicity.HELD_OUT == 0
