"""Fixed records and literals with hand-derived results."""

import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import fixed_records as R
from textloom import schemas
from textloom.functions import cleaning as C
from textloom.functions import validation as V
from textloom.operators.chunking import chunk_rows
from textloom.operators.records import clean_dialogues, clean_records, clean_turns
from textloom.options import ChunkOptions, CleanOptions


def apply(spark, values, function):
    """Results of a column function, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    return [r.out for r in df.select("i", function(F.col("text")).alias("out")).orderBy("i").collect()]


def text_records(spark):
    rows = [(i, 0, lang, text) for i, (lang, text) in enumerate(R.TEXTS)]
    return spark.createDataFrame(rows, schemas.TEXT)


def dialogue_records(spark):
    return spark.createDataFrame(
        [(i, lang, messages) for i, (lang, messages) in enumerate(R.DIALOGUES)], schemas.DIALOGUE
    )


def test_texts(spark):
    kept = {r.doc_id: r.text for r in clean_records(text_records(spark)).collect()}
    assert kept == {i: t for i, t in enumerate(R.CLEAN_TEXTS) if t is not None}


def test_texts_are_too_short_to_chunk(spark):
    assert chunk_rows(clean_records(text_records(spark)), ChunkOptions()).count() == 0


def test_dialogues(spark):
    rows = clean_dialogues(dialogue_records(spark)).collect()
    kept = {r.doc_id: [m.content for m in r.messages] for r in rows}
    assert kept == {i: m for i, m in enumerate(R.CLEAN_DIALOGUES) if m is not None}
    roles = {r.doc_id: [m.role for m in r.messages] for r in rows}
    assert all(roles[i] == [role for role, _ in R.DIALOGUES[i][1]] for i in roles)


def test_dialogues_by_turn(spark):
    turns = dialogue_records(spark).select(
        "doc_id", "lang", F.posexplode("messages").alias("turn", "m")
    ).select("doc_id", "lang", "turn", "m.role", "m.content")
    kept = {}
    for r in clean_turns(turns, "doc_id", "content").orderBy("doc_id", "turn").collect():
        kept.setdefault(r.doc_id, []).append(r.content)
    assert kept == {i: m for i, m in enumerate(R.CLEAN_DIALOGUES) if m is not None}


def test_empty_and_missing_message_lists_survive(spark):
    df = spark.createDataFrame([(1, "en", []), (2, "en", None)], schemas.DIALOGUE)
    assert {r.doc_id: r.messages for r in clean_dialogues(df).collect()} == {1: [], 2: []}


def test_message_that_cleans_to_nothing_drops_the_dialogue(spark):
    df = spark.createDataFrame(
        [(1, "en", [("user", "Hello there"), ("assistant", "www.example.com")])], schemas.DIALOGUE
    )
    assert clean_dialogues(df).count() == 0


@pytest.mark.parametrize("raw,expected", R.CHAIN.items())
def test_chain(spark, raw, expected):
    assert apply(spark, [raw], C.clean_normalized) == [expected]


def test_nfkc(spark):
    assert apply(spark, [*R.NFKC, None], C.nfkc) == [*R.NFKC.values(), None]


def test_nfkc_precedes_the_patterns(spark):
    raw = ["текст， ещё текст …и конец", "Ｗｗｗ．example.com/x and words"]
    assert apply(spark, raw, C.clean_text) == ["текст, ещё текст... и конец", "and words"]


@pytest.mark.parametrize("batch,wrap", [(C._nfkc_batch, lambda t: t), (C._nfkc_lists, lambda t: [t, "plain"])])
def test_nfkc_holds_few_texts_of_a_batch_at_a_time(batch, wrap):
    kind = pa.list_(pa.string()) if isinstance(wrap(""), list) else pa.string()
    composed = pa.array([wrap(f"{i} ﬁ" + "д" * 20_000) for i in range(600)], kind)
    normal = pa.array([wrap("é" * 20_000)] * 600 + [None], kind)
    tracemalloc.start()
    try:
        changed, same = batch.func(composed), batch.func(normal)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < composed.nbytes / 4
    # texts that stay as they are do not come back
    assert (len(same), same.null_count) == (601, 601) and same.nbytes < normal.nbytes / 100
    assert changed.to_pylist() == [wrap(f"{i} fi" + "д" * 20_000) for i in range(600)]


def test_nfkc_of_texts_and_lists_with_and_without_changes(spark):
    texts = [None, "", "plain", "é", "e\u0301", "ﬁ", "д…", "д", "\u1100\u1161", "\U0001d400", "a\u0323\u0307", "a\u0307\u0323"]
    normal = lambda t: None if t is None else unicodedata.normalize("NFKC", t)
    assert apply(spark, texts, C.nfkc) == [normal(t) for t in texts]
    lists = [None, [], [None], ["plain"], ["é", None], ["ﬁ", None, "é", ""], texts]
    df = spark.createDataFrame(list(enumerate(lists)), "i int, texts array<string>")
    found = df.select("i", C.nfkc_each(F.col("texts")).alias("out")).orderBy("i").collect()
    assert [r.out for r in found] == [None if ts is None else list(map(normal, ts)) for ts in lists]


def test_steps(spark):
    cases = [
        (C.drop_special_tokens, "a<|x y|>b[inst]c[/SYS]d<EndOfText>e<|\n|>", "abcde<|\n|>"),
        (C.drop_urls, "a HTTPS://x.y/z?q b xwww.foo c@d @e f@ @g@h (WWW.a)", "a  b x  @e f@  ("),
        (C.drop_control, "a\x00b\x08\x0b\x0c\x1f\x7f\x9fc\td\ne\r", "abc\td\ne\r"),
        (C.drop_technical, "a[1]b[1234567]c{x}d{}e{\n}", "ab[1234567]cd{}e{\n}"),
        (C.squeeze_repeats, "aaaa bbbbb cccccccc \n\n\n\n\n\n", "aaaa bbb ccc \n\n\n\n\n\n"),
        (C.drop_empty_pairs, "a \" ' b ( ] c « \n » d ()", "a  b  c  d "),
        (C.drop_lonely_marks, 'a " " ( b "c" )', 'a       b "c" )'),
        (C.fix_punctuation, "a \n , b;c .d e...f 1.5 ..g", "a, b; c. d e... f 1.5.. g"),
        (C.fix_whitespace, " \x1c a \t b\n\n\nc \n\xa0", "a b\nc"),
    ]
    for step, raw, expected in cases:
        assert apply(spark, [raw], step) == [expected], step.__name__


def test_strip_knows_every_whitespace_character(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert len(spaces) == 29
    assert apply(spark, [f"{s}x y{s}" for s in spaces], C.py_strip) == ["x y"] * 29


def test_character_classes(spark):
    """Letters and digits count like the Unicode categories they stand for."""
    sample = "aZéñßжЯ字かمא٣५½Ⅷ_²- \t!"
    letters, alnum = sum(c.isalpha() for c in sample), sum(c.isalnum() for c in sample)
    spaces = sum(c.isspace() for c in sample)
    from textloom.functions import patterns as P

    outside = [V._count_outside(F.lit(sample), chars) for chars in (P.LETTER, P.ALNUM, P.ALNUM + P.SPACE)]
    got = spark.range(1).select(*[c.alias(str(i)) for i, c in enumerate(outside)]).first()
    n = len(sample)
    assert tuple(got) == (n - letters, n - alnum, n - alnum - spaces)


def test_predicates(spark):
    garbage = ["", "a", "ab", "a....", "a...", "ab" + "!" * 4, "12345", "a1234", "abc   "]
    assert apply(spark, garbage, V.is_garbage) == [True, True, False, True, True, True, True, False, False]
    valid = ["", "ab", "abc", "abc%", "абв+" * 10, "a" * 17 + "%%%", "a" * 16 + "%%%%", "a_b (c)-d!?"]
    assert apply(spark, valid, V.is_valid) == [False, False, True, False, False, True, False, True]
    code = ["def definition from_ from", "{}[];", "return\nreturn(return)", "ÿimport import", ""]
    assert apply(spark, code, V.code_hits) == [2, 5, 3, 1, 0]


def test_long_inputs_stay_linear(spark):
    blanks, token = " " * 100_000 + "x", "a" * 100_000 + " b"
    assert apply(spark, [blanks, token], C.clean_normalized) == ["x", "aaa b"]
    mixed = "ab" * 40_000
    assert apply(spark, [mixed + "@x y", mixed + "@"], C.drop_urls) == [" y", mixed + "@"]


def test_long_texts_stay_whole_unless_limited(spark):
    text = "ab " * 100_000 + "c"
    assert [len(t) for t in apply(spark, [text], C.clean_text)] == [len(text)]
    limited = lambda t: C.clean_text(t, max_chars=len(text) - 1)
    assert apply(spark, [text, text[1:]], limited) == ["", text[1:]]
    records = spark.createDataFrame([(1, 0, "en", text)], schemas.TEXT)
    assert clean_records(records).first().text == text
    chunks = chunk_rows(records, ChunkOptions(target_tokens=512, stride_tokens=512, safety_margin=1.0, min_tokens=1)).orderBy("k")
    assert "".join(r.text for r in chunks.collect()) == text
    assert clean_records(records, CleanOptions(max_text_chars=1000)).count() == 0


def test_unknown_language(spark):
    rows = [(1, 0, None, "some good text"), (2, 0, "en", "some good text"), (3, 0, "fr", "some good text")]
    df = spark.createDataFrame(rows, schemas.TEXT)
    assert [r.doc_id for r in clean_records(df).collect()] == [2]
    options = CleanOptions(allowed_langs=("unknown", "fr"))
    assert sorted(r.doc_id for r in clean_records(df, options).collect()) == [1, 3]


def test_code_filter_can_be_turned_off(spark):
    df = spark.createDataFrame([(1, 0, "en", "def class import from return of the words")], schemas.TEXT)
    assert clean_records(df).count() == 0
    assert clean_records(df, CleanOptions(remove_code=False)).count() == 1
