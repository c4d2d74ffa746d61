"""Character classes, patterns and word lists of the normative text rules.

Fixed values: every constant in this module defines the result of a cleaning or
validation rule, so none of them may be tuned.  They are Java regular
expressions whose classes are spelled out to mean the same as the Unicode
classes of the rules (Java's ``\\w``, ``\\d`` and ``.`` differ from them).
"""

# ---------------------------------------------------------------- fixed values
# Character classes, for use inside [...]; SPACE needs the (?U) flag.
LETTER = r"\p{L}"
ALNUM = r"\p{L}\p{N}"
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"
SPACE = r"\s\x1c-\x1f"
CYRILLIC = r"\x{400}-\x{4FF}"

W = f"[{SPACE}]"
N = f"[^{SPACE}]"
QUOTES = "\"'«»„”“‘’`"
OPENERS = "([{<"
CLOSERS = ")]}>"

# Cleaning steps: (pattern, replacement).
SPECIAL_TOKENS = (
    r"(?iu)<\|[^>\n]{1,100}\|>"
    r"|\[(?:INST|/INST|ASST|/ASST|SYS|/SYS)\]"
    r"|<endoftext>|<endofprompt>|<startoftext>",
    "",
)
URL_EMAIL = (
    rf"(?iuU)https?://{N}+|www\.{N}+"
    # a token holding x@y, entered at its first character only: linear on long tokens
    rf"|(?<!{N}){N}[^{SPACE}@]*+@{N}+",
    "",
)
# 00-08, 0B, 0C, 0E-1F and 7F-9F, written as the complement: common characters match its first range
CONTROL = (r"[^\x20-\x7E\xA0-\x{10FFFF}\t\n\r]", "")
TECHNICAL = (rf"\[{DIGIT}{{1,6}}\]|\{{[^{{}}\n]{{1,100}}\}}", "")
REPEATS = (r"([^\n])\1{4,}", "$1$1$1")
# the look-ahead passes over letters and blanks by one test instead of several
EMPTY_PAIRS = (rf"(?U)(?![{LETTER} ])(?:[{QUOTES}]{W}*[{QUOTES}]|[(\[{{<]{W}*[)\]}}>])", "")
LONELY_MARKS = (rf"(?U)(?![{LETTER} ])(?<={W})[{QUOTES}()\[\]{{}}<>](?={W})", " ")
# entered at the first blank of a run and possessive: linear on long blank runs
SPACE_BEFORE_PUNCT = (rf"(?U){W}(?<!{W}{W}){W}*+([,.;:!?])", "$1")
HAS_SPACE_BEFORE_PUNCT = rf"(?U)[,.;:!?](?<={W}.)"
SPACE_AFTER_PUNCT = (rf"(?U)([,;:!?])({N})", "$1 $2")
# one dot or three
SPACE_AFTER_DOT = (rf"(?U)(\.(?:\.\.)?+)([^{SPACE}.{DIGIT}])", "$1 $2")
SPACE_AFTER_DASH = (rf"(?U)^([—\-])({N})", "$1 $2")
BLANK_RUNS = (r"[ \t]{2,}", " ")
NEWLINE_RUNS = (r"\n{2,}", "\n")
# every whitespace character, as stripped from both ends of a text
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Validation.
WEIRD_ALLOWED = rf"{WORD}{SPACE}{CYRILLIC}.,!?()\-"
CODE_WORDS = ("def", "class", "import", "from", "return", "lambda", "async", "await")
CODE_MARKS = r"{}\[\];"

# Thresholds.
MIN_LETTER_RATIO = 0.2
MAX_SPECIAL_RATIO = 0.6
VALID_RATIO = 0.85
MIN_VALID_CHARS = 3
MIN_CODE_HITS = 5
# ------------------------------------------------------------ end fixed values
