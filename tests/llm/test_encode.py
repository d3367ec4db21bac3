import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from terraloom.llm.encode import DuckMerges, decode_corpus, encode_corpus, tiktoken_words
from terraloom.llm.units import PRETOKEN, UnitEncoder, safe_parts, split_units

#: Fixed value: the published pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MERGES = DuckMerges()
LIBRARY = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=MERGES.ranks, special_tokens={})
LIBRARY_WORDS, _ = tiktoken_words()
ODD = [
    "", " ", "  ", "\n", " \n", "\n\n\nq", "a  b", "a   b", "x \n y", "x\n  y\n", "tab\t\tx", "a b　 c", "\x0cPAGE\x0c\n", "a\x00b", "\x1c\x1d \x85x",
    "don't I'LL we're 's", "<|endoftext|> no special", "½ 1½d Ⅷ ٣", "한국어 日本語 \U0001f600\U0001f468‍\U0001f469", "-" * 500, "a" * 300, "é ſoſ",
]


def ids_of(texts):
    enc = UnitEncoder(MERGES.encode_words, most_chars=2000)
    out = []
    for t in texts:  # one by one, so that the memory starts afresh in between
        units, _ = enc.numbered([t])
        out.append(enc.gather(units).tolist())
    return out


def test_odd_texts_match_the_library():
    assert ids_of(ODD) == [LIBRARY.encode_ordinary(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\x0c.'ab Zé½　’\x001")), max_size=40))
def test_units_never_cut_a_pretoken(text):
    units = split_units(text)
    whole = PRETOKEN.findall(text)
    if "\x00" not in text:
        assert "".join(units) == text
    assert [w for u in units for w in PRETOKEN.findall(u)] == whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30).filter(lambda t: not any("\ud800" <= c <= "\udfff" for c in t)), max_size=5))
def test_any_text_matches_the_library(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_operator(spark, sf):
    extra = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "Hello  world", "x"), (3, "Hello  world", "x"), (None, "a", "x")], "doc_id bigint, text string, ids string")
    got = encode_corpus(extra).collect()
    assert [(r.doc_id, r.ids) for r in got][:2] == [(1, []), (2, [])]
    assert got[2].ids == LIBRARY.encode_ordinary("Hello  world") == got[3].ids and got[4].ids == [64]
    assert encode_corpus(extra.limit(0)).count() == 0
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in encode_corpus(docs).collect():
        assert r.ids == (LIBRARY.encode_ordinary(texts[r.doc_id]) if texts[r.doc_id] else [])
        assert LIBRARY.decode(r.ids) == (texts[r.doc_id] or "")


def test_very_long_text_in_parts(monkeypatch):
    from terraloom.llm import units

    text = "\n".join(f"word{i} (x),  y {i}\t\t\n\n z" for i in range(3000)) + "." * 5000
    assert "".join(safe_parts(text, 100)) == text and len(list(safe_parts(text, 100))) > 300
    monkeypatch.setattr(units, "MOST_LISTED", 500)
    monkeypatch.setattr(units.safe_parts, "__defaults__", (100,))
    assert ids_of([text]) == [LIBRARY.encode_ordinary(text)]


def test_word_encoder_of_sizes_is_the_same():
    enc, _ = tiktoken_words()
    words = [w for t in ODD for w in PRETOKEN.findall(t)]
    assert MERGES.encode_words(words) == [enc.encode_ordinary(w) for w in words]


def test_repeats_overlaps_and_long_words():
    words = ["a" * n for n in range(2, 40)] + ["-" * 2000, ".." * 700 + "x", "aaab" * 90 + "aa", "x" * 5000, "Zq9" * 600, "日本" * 300]
    assert MERGES.encode_words(words) == [LIBRARY_WORDS.encode_ordinary(w) for w in words]


def test_decoding_gives_the_texts_again(spark):
    rows = [(1, "Réef 日本語 \U0001f600 end."), (2, ""), (3, None), (None, "  two\n\n"), (1, "again")]
    back = decode_corpus(encode_corpus(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    assert [(r.doc_id, r.text) for r in back] == [(k, t or "") for k, t in rows]
    odd = spark.createDataFrame([(1, [99999999]), (2, [255, 255]), (3, None)], "doc_id bigint, ids array<int>")
    assert [r.text for r in decode_corpus(odd).collect()][::2] == ["", ""]
    assert decode_corpus(odd.limit(0)).count() == 0
