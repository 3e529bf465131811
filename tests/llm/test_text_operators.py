"""Operators that look at one text at a time, against the public libraries or plain versions."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from refpanel.llm import pieces, quality_rules, sanitise, token_count

from . import plain

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCRAPS = ["a", "er", "th", " ", "  ", "\n", "\t", "'s", "23", "é", "ß", "日本", "😀", " ", "　", "▁", "<|endoftext|>", "<s>", "<0x0A>", "!!", "\x00", "ing", "٣", "²", "\x85", "don't"]
texts = st.one_of(st.text(max_size=80), st.lists(st.sampled_from(SCRAPS), max_size=60).map("".join), st.text("thingerad ", max_size=120))


@settings(max_examples=400, deadline=None)
@given(texts)
def test_token_counts_are_the_librarys(text):
    library = Tokenizer.from_file(BPE) if not hasattr(test_token_counts_are_the_librarys, "lib") else test_token_counts_are_the_librarys.lib
    test_token_counts_are_the_librarys.lib = library
    assert token_count.load(BPE).count(text) == len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_pieces_are_the_librarys(text):
    if not hasattr(test_pieces_are_the_librarys, "lib"):
        test_pieces_are_the_librarys.lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    library = test_pieces_are_the_librarys.lib
    ids = library.encode(text, add_bos=True, add_eos=True)
    packed, n, decoded = pieces.load(PIECES).encode(text)
    assert (packed, n, decoded) == (np.array(ids, "<u4").tobytes(), len(ids), library.decode(ids))
    assert pieces.load(PIECES).decode(ids) == library.decode(ids)


def test_long_runs():
    library, bpe = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(BPE)
    for text in ("a" * 20_000, "ab" * 9000, " " * 9000, "é" * 5000, "Er " * 4000, "!" * 9000):
        assert pieces.load(PIECES).encode(text)[1] == 2 + len(library.encode(text))
        assert token_count.load(BPE).count(text) == len(bpe.encode(text).ids)


def test_token_rows(odd, nothing):
    rows = token_count.count_tokens(odd, BPE).collect()
    assert len(rows) == 10 and [(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (2, 3)] == [(0, 0)] * 2
    assert [r.over_limit for r in rows if r.doc_id == 5] == [True]
    assert token_count.count_tokens(nothing, BPE).count() == 0


def test_piece_rows(odd, nothing):
    rows = pieces.encode(odd, PIECES)
    assert {r.doc_id: r.n_tokens for r in rows.collect() if r.doc_id in (2, 3)} == {2: 2, 3: 2}
    back = pieces.decode(rows.select("ids", "decoded").withColumnRenamed("decoded", "was"), PIECES)
    assert back.filter("NOT (decoded <=> was)").count() == 0
    source = {r.doc_id: r.text or "" for r in odd.collect()}
    assert all(r.decoded == source[r.doc_id] for r in rows.collect())
    assert pieces.encode(nothing, PIECES).count() == 0


def test_quality_counts(spark, odd, nothing):
    scraps = ["a b c", "a b c", "x", "#$", "\n", "\n\n", " ", "Wort é", "|", "y y y y", "\x0b"]
    draw = random.Random(4)
    made = [(k, "".join(draw.choice(scraps) for _ in range(draw.randint(0, 30))), "en", "s") for k in range(300)]
    docs = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    for r in quality_rules.filter_quality(docs).collect():
        want = plain.quality(made[r.doc_id][1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    rows = quality_rules.filter_quality(odd).collect()
    assert len(rows) == 10 and all(r.base_failed for r in rows if r.doc_id in (2, 3, 4, 8))
    assert quality_rules.filter_quality(nothing).count() == 0


def test_quality_thresholds_follow_the_group(spark):
    """A symbol share that is usual in one source is cut in another."""
    clean = " ".join(f"w{k}" for k in range(60))
    rows = [(k, f"{clean} {' '.join('#' * (20 if s == 'code' else 0))} v{k}", "en", s) for s in ("code", "news") for k in range(100)]
    rows.append((1000, f"{clean} {'# ' * 20}", "en", "news"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    dropped = quality_rules.filter_quality(docs).filter("NOT kept").collect()
    assert [r.doc_id for r in dropped] == [1000]


def test_quality_bounds_have_no_floor(spark):
    """A few symbols are too many in a source without any, and longer words where all are short."""
    clean = " ".join(f"w{k}" for k in range(200))
    rows = [(k, f"{clean} v{k}", "en", "news") for k in range(100)]
    rows += [(1000, f"{clean} {'# ' * 10}", "en", "news"), (1001, " ".join(f"longer{k}" for k in range(200)), "en", "news")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    dropped = quality_rules.filter_quality(docs).filter("NOT kept").collect()
    assert sorted(r.doc_id for r in dropped) == [1000, 1001]


def test_quality_verdict_is_that_of_exact_quantiles(spark):
    """Groups small enough for their sketches to be exact, against sorted values."""
    draw = random.Random(12)
    rows = []
    for k in range(600):
        words = [draw.choice(["alpha", "be", "gamma-delta", "x", "LOUD"][: draw.choice([2, 4, 5])]) + str(draw.randrange(40)) for _ in range(draw.randint(40, 160))]
        text = draw.choice([" ", "\n"]).join(words) + draw.choice(["", "", "", " # $", " |" * 30]) + draw.choice(["", "\nsame\nsame"])
        rows.append((k, text, draw.choice(["en", None]), draw.choice("ab")))
    for k in range(600, 616):
        rows.append((k, " ".join(f"{'longer' * (k % 2)}w{j}{' #$' * (1 - k % 2)}" for j in range(90)), "en", "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    measured = {r.doc_id: r.asDict() for r in quality_rules.measure(docs).collect()}
    failed = {k for k, m in measured.items() if m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"]}
    ratios = {"symbols_per_word": "n_symbols", "repeated_share": "n_repeat_words", "dup_line_share": "n_dup_lines", "shouting_share": "n_shouted", "word_chars_mean": "word_chars"}
    ratio = lambda k, r: measured[k][ratios[r]] / max(measured[k]["n_words"], 1)
    kept = set()
    for group in {r[2:] for r in rows}:
        mine = [r[0] for r in rows if r[2:] == group]
        base = [k for k in mine if k not in failed]
        at = lambda values, q: sorted(values)[max(math.ceil(q * len(values)) - 1, 0)]
        one = 1 / at([measured[k]["n_words"] for k in base], 0.5)
        top = {r: max(t * at([ratio(k, r) for k in base], q), n * one) for r, q, t, n in quality_rules.TAIL_RULES}
        means = [ratio(k, "word_chars_mean") for k in base]
        low, high = at(means, 0.25), at(means, 0.75)
        spread = max(high - low, one)
        fence = low - quality_rules.WORD_FENCE[0] * spread, high + quality_rules.WORD_FENCE[1] * spread
        kept |= {k for k in base if all(ratio(k, r) <= top[r] for r in top) and fence[0] <= ratio(k, "word_chars_mean") <= fence[1]}
    assert {r.doc_id for r in quality_rules.filter_quality(docs).filter("kept").collect()} == kept and 0 < len(kept) < len(rows) - len(failed)


def test_entities(spark):
    scraps = ["a@b.co", "a", "@", ".", "+", "1", "23", "4444", "4539148803436467", "1.2.3.4", "300.1.1.1", " ", "-", "(", "é", "😀", "x@y.z%q@r.s", "+1 (706) 555-3138", "_", "5555 5555 5555 4444", "0", "%"]
    draw = random.Random(3)
    made = ["".join(draw.choice(scraps) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").select("doc_id", sanitise.entity_spans(sanitise.F.col("text")).alias("s")).collect()
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.s] == plain.entities(made[r.doc_id])


def test_disclosing_terms(spark):
    """A name that is only written next to one address is removed from texts that hold it, a name
    mostly so is generalised, common words stay."""
    rows = [(k, f"Please write to Zanzibar or Kepler at jo@example.org about the matter, said Zanzibar number {k}") for k in range(6)]
    rows += [(10 + k, f"the matter about which Kepler wrote to you is number {k}") for k in range(2)]
    rows += [(20 + k, f"please write about the matter at hand, number said or to {k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in sanitise.report(docs).collect()}
    text = rows[0][1]
    shown = [text[int(a) : int(b)] for kind, a, b in (s.split(":") for s in found[0].spans.split(",")) if kind == "term"]
    assert sorted(shown) == ["Kepler", "Zanzibar", "Zanzibar"]
    assert found[0].base == "email:38:52" and found[10].spans == "" and found[0].n_email == 1
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert clean[0] == "Please write to  or [term] at [email] about the matter, said  number 0"
    assert clean[10] == rows[6][1]


def test_single_documents_disclose(spark):
    """A name written only in the one document of a unique address goes, however far from it; words
    that other documents use stay."""
    far = " ".join(["please write about the matter"] * 10)
    rows = [(1, f"Quagmire said {far} to jo@example.org"), (2, "jim@example.org said Xanadu"), (3, "Xanadu to jim@example.org")]
    rows += [(10 + k, f"please write about the matter said to {k}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert clean[1] == f"[term] said {far} to [email]"
    assert clean[2] == "[email] said [term]" and clean[3] == "[term] to [email]"
    assert all(clean[r[0]] == r[1] for r in rows[3:])


def test_disclosure_does_not_depend_on_the_size_of_the_corpus(spark):
    """A hundred times as many unrelated documents leave every span as it was."""
    rows = [(1, "jo@example.org keeps a zebrafish and an okapi"), (2, "zebrafish are small"), (3, "zebrafish swim"), (4, "Okapi for jo@example.org"), (5, "jo@example.org once wrote unum")]
    padded = rows + [(10 + k, f"other words in number {k} of them") for k in range(500)]
    spans = lambda r: {x.doc_id: x.spans for x in sanitise.report(spark.createDataFrame(r, "doc_id long, text string")).collect() if x.doc_id < 10}
    assert spans(rows) == spans(padded) and "term" in spans(rows)[5]


def test_sanitise_rows(odd, nothing):
    done = sanitise.sanitise(odd)
    assert done.columns == odd.columns and done.count() == 10
    rows = {r.doc_id: r for r in done.collect()}
    assert rows[2].text is None and rows[None].text.endswith("a mail [email] in it") and rows[3].text == ""
    report = sanitise.report(odd).collect()
    assert sum(r.n_email for r in report) == 1 and len(report) == 10
    assert sanitise.report(nothing).count() == sanitise.sanitise(nothing).count() == 0


@pytest.mark.parametrize("size", [0, 1])
def test_prefix_table_is_unique(size):
    """Each prefix of a prefix has the same last token."""
    p = pieces.load(PIECES)
    text = "▁international" + "s" * size
    table = p.prefix_table(text)
    assert all(p.prefix_table(text[:k]) == table[:k] for k in range(1, len(text)))
