import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from visitlake.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TEXTS = ["", "Hello's  world\n\n  it'll be 12345 ok!!!", "ção ñandú  größe 日本語テキスト 🙂🙂", "a" * 3000, " " * 500 + "x", "\t\r\n \x00\x01",
         "thththththerererere " * 40, "I'm'reve 'll''d  's", "Ｋelvin ſ   end", "<|endoftext|>"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.encoder_for(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(encoder, library, text):
    want = library.encode_ordinary(text)
    packed = encoder.encode(text)
    assert [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)] == want
    assert encoder.decode(packed) == text.encode()


def test_random_bytes_of_one_piece(encoder):
    rng = random.Random(3)
    for _ in range(60):
        data = bytes(rng.choice(b"therinaon \xc3\xa9") for _ in range(rng.randrange(1, 60)))
        assert bpe.PrefixTable(encoder.vocabulary, data).tokens() == encoder.vocabulary.merged(data)


def test_every_prefix_appends_and_edits(encoder):
    rng, vocabulary = random.Random(5), encoder.vocabulary
    table = bpe.PrefixTable(vocabulary)
    for chunk in (b"the", b"reinthe", b"r", b"ation" * 30):
        table.append(chunk)
    for end in range(0, len(table.data), 7):
        assert table.tokens(end) == vocabulary.merged(table.data[:end])
    table = bpe.PrefixTable(vocabulary, b"thereinonation" * 100)
    for _ in range(20):
        start = rng.randrange(len(table.data))
        computed = table.replace(start, start + rng.randrange(4), rng.choice([b"", b"xq", b"the"]))
        assert table.tokens() == bpe.PrefixTable(vocabulary, table.data).tokens()
        assert computed <= 3 * vocabulary.longest + 3 or start + computed >= len(table.data) - 3


def test_edits_of_a_text(encoder, library):
    rng, text = random.Random(7), "It's the end, isn't it?  We'll see 1234 things\n\n  soon. " * 20
    editable = bpe.EditableText(encoder, text)
    for new in ["", "'", "r", "e", " ", "  ", "ll", "x9", "\n"] * 6:
        start = rng.randrange(len(editable.text) + 1)
        end = min(len(editable.text), start + rng.randrange(3))
        computed = editable.replace(start, end, new)
        assert editable.ids() == library.encode_ordinary(editable.text)
        assert computed < 20
    editable.append("'s more")
    assert editable.ids() == library.encode_ordinary(editable.text)


def test_documents(spark, library):
    rows = [(1, "same text", "x"), (1, "same text", "y"), (2, None, "x"), (3, "", "x"), (None, "no id", None), (4, "word " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(bpe.encode_documents(docs, PATH, PATTERN, keep_ids=True).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 1, 2, 3, 4, None]
    for row, text in zip(got, ["same text", "same text", "", "", "word " * 50_000, "no id"], strict=True):
        ids = library.encode_ordinary(text)
        assert (row.n_tokens, row.ids) == (len(ids), ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(docs.limit(0), PATH, PATTERN).count() == 0


def test_query_on_whole_documents(spark, sf_dir, library):
    from visitlake.llm.queries import op2_prefix_bpe

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op2_prefix_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_few_texts_are_held_at_once(encoder, monkeypatch):
    class Table:
        def mapInPandas(self, encode, schema):
            return encode

    monkeypatch.setattr(bpe, "importable", lambda docs: docs)
    monkeypatch.setattr(bpe, "narrow", lambda docs, **columns: docs)
    monkeypatch.setattr(bpe, "TEXTS_AT_ONCE", 3)
    encode = bpe.encode_documents(Table(), PATH, PATTERN, keep_ids=True)
    texts = [*TEXTS, None]
    parts = list(encode(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": texts}), pd.DataFrame({"doc_id": [99], "text": ["last"]})])))
    assert [len(p) for p in parts] == [3, 3, 3, 2, 1]
    ids = {r.doc_id: r.ids.tolist() for p in parts for r in p.itertuples()}
    assert ids == {i: np.frombuffer(encoder.encode(t or ""), dtype="<u4").tolist() for i, t in [*enumerate(texts), (99, "last")]}
