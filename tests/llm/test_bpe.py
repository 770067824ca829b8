import numpy as np
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from colophon.llm import bpe as B

SCHEMA = "doc_id long, text string, token_ids string, n_tokens string"
RANKS = B.read_ranks(open(B.VOCABULARY, "rb").read())
ENCODER = B.Encoder(RANKS)
WHOLE = tiktoken.Encoding("whole", pat_str=B.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def plain(text):
    """Byte-pair merges, one at a time, of each piece that the pattern finds."""
    out = []
    for piece in regex.findall(B.PATTERN, text):
        parts = [bytes([b]) for b in piece.encode()]
        while len(parts) > 1:
            rank, k = min((RANKS.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
            if rank == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        out += [RANKS[p] for p in parts]
    return out


def encode(texts):
    raw = [t.encode() for t in texts]
    ids, n = ENCODER.encode(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])])
    at = np.r_[0, np.cumsum(n)]
    back, ends = ENCODER.decode(ids, n)
    assert [back[a:b].tobytes() for a, b in zip(ends, ends[1:])] == raw
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


TRICKY = ["", " ", "it's", "!'s fine", "x  y\n\n z", "don''t", "　a b c", "1a2'll", "a—'s", "ß$'ve", "<|endoftext|>", "the end   ", "\t\tcode()", "'S 'rest", "é \U0001f600s", "$$$ %%%word&&&", "..''re", " 'd", "\x85x"]


def test_tricky_texts():
    assert encode(TRICKY) == [WHOLE.encode_ordinary(t) for t in TRICKY] == [plain(t) for t in TRICKY]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" '\n\tsterveldma.!$&1é  ß")), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_any_text(texts):
    assert encode(texts) == [WHOLE.encode_ordinary(t) for t in texts]


def test_cut_pairs_stand_in_no_token():
    cut = B.forced_cuts(RANKS)
    assert cut.sum() > 30000 and not any(cut[t[i], t[i + 1]] for t in RANKS for i in range(len(t) - 1))


def test_table_starts_afresh(monkeypatch):
    monkeypatch.setattr(B, "TABLE", 3)
    for _ in range(3):
        assert encode(["some words that are new", "and others"]) == [WHOLE.encode_ordinary(t) for t in ("some words that are new", "and others")]


def test_whole_table_and_edge_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in B.encoded(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts) and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got.values())
    assert all(got[d].token_ids == WHOLE.encode_ordinary(t) for d, t in texts.items())
    assert {r.doc_id: r.text for r in B.decoded(B.encoded(docs)).collect()} == texts
    odd = spark.createDataFrame([(1, None, "c", "c"), (2, "", "c", "c"), (3, "long 's " * 40000, "c", "c"), (3, "x", "c", "c"), (None, "x", "c", "c")], SCHEMA)
    assert sorted((r.doc_id, r.n_tokens, r.round_trip) for r in B.encoded(odd).collect()) == [(1, 0, True), (2, 0, True), (3, 1, True), (3, len(WHOLE.encode_ordinary("long 's " * 40000)), True)]
    assert B.encoded(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.text for r in B.decoded(spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>")).collect()] == [""]
    with pytest.raises(FileNotFoundError):
        B.encoded(docs, "/nowhere")
