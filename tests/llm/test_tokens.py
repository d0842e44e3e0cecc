import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oreflow.llm import bitplanes
from oreflow.llm.bm25_packing import Index, pack, pieces, term_counts
from oreflow.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, 2)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aBhT's.,<|>_-%9é̱́̈—İΣς \n\t\x01  "), max_size=40))
def test_words_give_the_ids_of_the_text(encoder, text):
    ids, lengths = encoder.encode([text.encode()])
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]
    assert ids.tolist() == want and lengths.tolist() == [len(want)]


def test_special_token_strings(encoder):
    for text in ("a<|endoftext|>b", "A<|ENDOFTEXT|>b,c", "", "x" * 5000):
        assert encoder.encode([text.encode()])[0].tolist()[:-1] == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("ids", [[0], [1, 49407, 70000, 2**32 - 1], list(range(1000))])
def test_planes_round_trip(kind, ids):
    ids = np.array(ids, np.uint32)
    assert (bitplanes.from_planes(bitplanes.to_planes(ids, kind), kind, len(ids)) == ids).all()


def test_checksums_combine():
    data = bytes(range(256)) * 9
    parts = [data[:1], data[1:700], b"", data[700:]]
    assert bitplanes.crc32_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(data)


def whole(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return [(r.doc_id, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in docs.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_store(spark, odd_docs, tmp_path, kind):
    path = str(tmp_path / "store")
    bitplanes.write_tokens(odd_docs, path, PATH, kind=kind, block_ids=50)
    got = bitplanes.read_index(spark, path).orderBy("start").collect()
    want = whole(odd_docs)
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((len(i), crc(i)) for _, i in want)
    assert [r.doc_id for r in got] == sorted((d for d, _ in want), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_empty_store(spark, no_docs, tmp_path):
    path = str(tmp_path / "store")
    bitplanes.write_tokens(no_docs, path, PATH)
    assert bitplanes.read_index(spark, path).count() == 0


@pytest.mark.parametrize("shard_ids", [1, 300, 1 << 19])
def test_packing_places_each_id_once(odd_docs, shard_ids):
    sequences = pack(odd_docs, PATH, window=64, shard_ids=shard_ids).cache()
    rows = pieces(sequences).collect()
    docs, held = {}, {}
    for r in rows:
        docs.setdefault((r.doc_id, r.copy), []).append((r.start, r.length, r.doc_tokens))
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in docs.values():
        at = 0
        for start, length, _ in sorted(spans):
            assert start == at
            at += length
        assert at == spans[0][2]
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences.collect()}
    for number, spans in held.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == len(ids[number]) <= 64
    together = {}
    for r in sorted(rows, key=lambda r: r.start):
        together.setdefault((r.doc_id, r.copy), []).extend(ids[r.sequence_id][r.offset : r.offset + r.length].tolist())
    assert sorted(map(str, together.values())) == sorted(str(i) for _, i in whole(odd_docs))


def test_packing_nothing(no_docs):
    assert pack(no_docs, PATH).count() == 0


def test_index_scores_are_bm25():
    docs = [np.array(d) for d in ([1, 1, 2, 5], [2, 2, 3], [5, 1, 7, 7, 7], [9])]
    idf, mean = np.linspace(0.5, 2, 10), 3.25
    index = Index(docs, idf, mean)
    for i, seed in enumerate(docs):
        for j, other in enumerate(docs):
            want = sum(
                idf[t] * (f := (other == t).sum()) * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(other) / mean)) for t in set(seed.tolist())
            )
            assert index.scores(i)[j] == pytest.approx(want)
    assert [x.tolist() for x in term_counts(docs[:1])] == [[0, 0, 0], [1, 2, 5], [2, 1, 1]]


def test_neighbours_come_together(spark):
    kinds = ["apple pear plum cherry", "steel iron copper zinc", "river lake ocean sea"]
    docs = spark.createDataFrame([(i, " ".join([kinds[i % 3]] * 4)) for i in range(30)], "doc_id long, text string").coalesce(1)
    mixed = 0
    for seq in pack(docs, PATH, window=34, shard_ids=1 << 19).collect():
        mixed += len({p.doc_id % 3 for p in seq.pieces}) > 1
    assert mixed <= 3
