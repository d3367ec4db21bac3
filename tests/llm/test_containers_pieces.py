from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken

from terraloom.llm.containers import Capacity, fill, pack
from terraloom.llm.encode import tiktoken_words
from terraloom.llm.pieces import split_oversized

_, RANKS = tiktoken_words()
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIBRARY = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_fill_keeps_every_limit():
    rnd = np.random.default_rng(1)
    tokens = np.concatenate([rnd.integers(1, 2500, 700), rnd.integers(1, 5, 900), [0, 0, 2048, 5000]])
    loss = (tokens * rnd.uniform(0.4, 1.0, len(tokens))).astype(int)
    cap = Capacity(2048, 40, 1900)
    box = fill(tokens, loss, cap)
    assert (box[tokens == 0] == -1).all() and (box[tokens > 0] >= 0).all()
    for b in range(box.max() + 1):
        m = box == b
        assert m.sum() == 1 or (tokens[m].sum() <= cap.tokens and m.sum() <= cap.segments and loss[m].sum() <= cap.loss), b
        assert m.sum() >= 1
    assert (fill(np.zeros(0, int), np.zeros(0, int), cap)).size == 0


def test_ties_and_single_class():
    box = fill(np.full(10, 500), np.full(10, 100), Capacity(1000, 9, 1000))
    assert sorted(Counter(box).values()) == [2] * 5


def test_capacity_is_a_parameter_and_loss_over_it_is_marked(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "- - - -"), (3, "five six")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pack(docs, [8], capacity=lambda n: Capacity(n, 2, 3)).collect()}
    assert rows[1].over_loss and not rows[2].over_loss and not rows[3].over_loss
    assert rows[1].container_id not in (rows[2].container_id, rows[3].container_id) and rows[2].container_id == rows[3].container_id


def test_pack_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    n = {k: len(LIBRARY.encode_ordinary(t)) for k, t in texts.items()}
    rows = pack(docs, [512, 2048], items=40).collect()
    for limit in (512, 2048):
        mine = [r for r in rows if r.limit_tokens == limit]
        assert {r.doc_id for r in mine} == set(n)
        per_doc, per_box = defaultdict(list), defaultdict(list)
        for r in mine:
            per_doc[r.doc_id].append(r)
            per_box[r.container_id].append(r)
        for k, rs in per_doc.items():
            assert sum(r.n_tokens for r in rs) == n[k] and (len(rs) == 1 or n[k] > limit)
            assert [r.start_token for r in sorted(rs, key=lambda r: r.piece_no)] == [i * limit for i in range(len(rs))]
            assert (rs[0].container_id is None) == (n[k] == 0)
        cap = Capacity.usual(limit)
        per_box.pop(None, None)
        for rs in per_box.values():
            assert sum(r.n_tokens for r in rs) <= limit
            assert len(rs) == 1 or (len(rs) <= cap.segments and sum(r.n_loss for r in rs) <= cap.loss)
    big = [r for r in rows if r.limit_tokens == 2048 and r.container_id]
    used = sum(r.n_tokens for r in big) / 2048
    assert len({r.container_id for r in big}) <= used * 1.1 + 10  # shares of 40 documents: one open container each
    assert pack(docs.limit(0), [512]).count() == 0


def test_pieces(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = "x" * 9000 + " " + "日本語" * 900 + "\n\nend. " * 50
    docs = docs.unionByName(spark.createDataFrame([(10**9, odd), (10**9 + 1, None), (10**9 + 2, "")], "doc_id bigint, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {k: LIBRARY.encode_ordinary(t) for k, t in texts.items()}
    limits = [(512, 64), (256, 24), (40, 0)]
    rows = split_oversized(docs, limits).collect()
    kinds = Counter()
    for limit, overlap in limits:
        per = defaultdict(list)
        for r in rows:
            if r.limit_tokens == limit:
                per[r.doc_id].append(r)
        assert set(per) == {k for k, v in ids.items() if len(v) > limit}
        for k, rs in per.items():
            rs.sort(key=lambda r: r.piece_no)
            assert rs[0].start_token == 0 and rs[-1].start_token + rs[-1].n_tokens == len(ids[k]) and rs[-1].ends_at == "end"
            assert all(r.n_tokens <= limit for r in rs)
            assert all(b.start_token == a.start_token + a.n_tokens - overlap for a, b in zip(rs, rs[1:], strict=False))
            for r in rs:
                kinds[r.ends_at] += 1
                exact = b"".join(LIBRARY.decode_single_token_bytes(t) for t in ids[k][r.start_token : r.start_token + r.n_tokens])
                assert exact in r.text.encode() and len(r.text.encode()) - len(exact) <= 6
                if r.ends_at in ("page", "line"):
                    assert "\n" in r.text[len(r.text.rstrip()) :]
    assert kinds["page"] and kinds["line"] and kinds["word"] and kinds["token"]
    assert split_oversized(docs.limit(0), limits).count() == 0
    with pytest.raises(ValueError, match="progress"):
        split_oversized(docs, [(100, 60)])
