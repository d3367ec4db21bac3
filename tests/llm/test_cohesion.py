from collections import Counter

import numpy as np

from terraloom.llm.pieces import BLOCK, REACH, depths, describe, split_oversized


def test_depths_by_exact_word_counts():
    rnd = np.random.default_rng(5)
    lines = [[f"word{x}" for x in rnd.integers(0, 40 + 30 * (i // 9 % 2), rnd.integers(0, 9))] for i in range(60)]
    units, line = [w for ws in lines for w in ws], np.repeat(np.arange(60), [len(ws) for ws in lines])
    alike = []
    for g in range(1, 60):
        a, b = (Counter(w for ws in part for w in ws) for part in (lines[max(g - BLOCK, 0) : g], lines[g : g + BLOCK]))
        norm = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        alike.append(sum(a[w] * b[w] for w in a) / max(norm, 1e-9))
    want = [max(alike[max(i - REACH, 0) : i + 1]) + max(alike[i : i + REACH + 1]) - 2 * alike[i] for i in range(59)]
    assert np.allclose(depths(describe(units), line, 60), want)


def test_a_page_without_lines_is_cut_between_topics(spark):
    topics = ["Coral polyps build shallow reefs slowly. ", "Steam engines carried heavy freight daily. "]
    text = (topics[0] * 50 + topics[1] * 50).strip()
    rows = split_oversized(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), [(512, 0)]).collect()
    first = min(rows, key=lambda r: r.piece_no)
    assert first.ends_at == "sentence" and "engines" not in first.text and first.text.count("Coral") == 50
    plain = " ".join(["coral polyps"] * 400)
    rows = split_oversized(spark.createDataFrame([(2, plain)], "doc_id bigint, text string"), [(300, 0)]).collect()
    assert {r.ends_at for r in rows} == {"word", "end"} and "".join(r.text for r in sorted(rows, key=lambda r: r.piece_no)) == plain


def test_scripts_without_blanks_have_words():
    notes = describe(["海", "the", "珊瑚礁", "reef", ",", " a"])
    assert [n >> 4 > 0 for n in notes] == [True, False, True, True, False, False]


def test_cuts_fall_between_planted_topics(spark):
    """Twenty pages of topics with words of their own: every cut falls within one line of a change of topic, where the window holds one."""
    rnd, good, texts = np.random.default_rng(11), 0, []
    for p in range(20):
        lines = []
        for t in range(4):
            words = [f"topic{p}x{t}x{k}" for k in range(25)]
            lines += [" ".join(rnd.choice(words, 6)) for _ in range(7)]
        texts.append((p, "\n".join(lines)))
    rows = split_oversized(spark.createDataFrame(texts, "doc_id bigint, text string"), [(700, 0)]).collect()
    cuts = [r for r in rows if r.ends_at == "line"]
    for r in cuts:
        line = dict(texts)[r.doc_id][: r.start_char + len(r.text)].count("\n")
        good += min(abs(line - k) for k in (7, 14, 21)) <= 1
    assert len(cuts) >= 20 and good >= 0.9 * len(cuts)
