"""The tuned cleaning steps against the plain patterns of the rules, on random strings."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import cleaning as C
from textloom.functions import validation as V

# ---------------------------------------------------------------- fixed values
W, N = r"[\s\x1c-\x1f]", r"[^\s\x1c-\x1f]"
PLAIN = {
    C.drop_special_tokens: [
        (r"(?iu)<\|[^>\n]{1,100}\|>|\[(?:INST|/INST|ASST|/ASST|SYS|/SYS)\]|<endoftext>|<endofprompt>|<startoftext>", "")
    ],
    C.drop_urls: [(rf"(?iuU)https?://{N}+|www\.{N}+|{N}+@{N}+", "")],
    C.drop_control: [(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]", "")],
    C.drop_technical: [(r"\[\p{Nd}{1,6}\]|\{[^{}\n]{1,100}\}", "")],
    C.squeeze_repeats: [(r"([^\n])\1{4,}", "$1$1$1")],
    C.drop_empty_pairs: [(rf"(?U)[\"'«»„”“‘’`]{W}*[\"'«»„”“‘’`]|[(\[{{<]{W}*[)\]}}>]", "")],
    C.drop_lonely_marks: [(rf"(?U)(?<={W})[\"'«»„”“‘’`()\[\]{{}}<>](?={W})", " ")],
    C.fix_punctuation: [
        (rf"(?U){W}+([,.;:!?])", "$1"),
        (rf"(?U)([,;:!?])({N})", "$1 $2"),
        (r"(?U)(\.{3}|\.)([^\s\x1c-\x1f.\p{Nd}])", "$1 $2"),
        (rf"(?U)^([—\-])({N})", "$1 $2"),
    ],
    C.fix_whitespace: [(r"[ \t]{2,}", " "), (r"\n{2,}", "\n"), (rf"(?U)^{W}+|{W}+\z", "")],
}
# ------------------------------------------------------------ end fixed values

PIECES = [
    *"ab.,;:!?-—@<>|[](){}\"'«»„” \t\n\r\x0b\x1c\x85\xa0 ​\x00\x7f\x9fñЖ字٣7_", "...", "aaaaa", "@@", "..", "  ",
    "https://", "HTTP://", "WwW.", "www", "<|", "|>", "[INST]", "[/sys]", "<endOfText>", "[12]", "{x}", "\n\n", "\U0001f600",
    "def", "class", "import", "from", "return", "lambda", "async", "await",
]


@pytest.fixture(scope="module")
def strings(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 25)))) for i in range(6000)]
    df = spark.createDataFrame(rows, "i int, text string").repartition(4, "i").cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("step", PLAIN, ids=lambda step: step.__name__)
def test_step_equals_plain_patterns(strings, step):
    plain = F.col("text")
    for pattern, replacement in PLAIN[step]:
        plain = F.regexp_replace(plain, F.lit(pattern), F.lit(replacement))
    both = strings.select("text", step(F.col("text")).alias("tuned"), plain.alias("plain"))
    assert both.where(F.col("tuned") != F.col("plain")).limit(3).collect() == []


def test_predicates_equal_character_counts(strings):
    """Counts of single characters and whole words, straight from the definitions."""
    words = {"def", "class", "import", "from", "return", "lambda", "async", "await"}
    rows = strings.select(
        "text",
        V.is_garbage(F.col("text")).alias("garbage"),
        V.is_valid(F.col("text")).alias("valid"),
        V.code_hits(F.col("text")).alias("hits"),
    ).collect()
    for text, garbage, valid, hits in rows:
        n = len(text)
        letters = sum(map(str.isalpha, text))
        special = n - sum(map(str.isalnum, text)) - sum(map(str.isspace, text))
        assert garbage == (n < 2 or letters / n < 0.2 or special / n > 0.6), repr(text)
        usual = sum(c.isalnum() or c.isspace() or c in "_.,!?()-" or "Ѐ" <= c <= "ӿ" for c in text)
        assert bool(valid) == (n >= 3 and 1 - (n - usual) / n >= 0.85), repr(text)
        tokens = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
        assert hits == sum(t in words for t in tokens) + sum(c in "{}[];" for c in text), repr(text)
