"""Text functions as Column -> Column expressions (JVM side; lambdas are evaluated, not
compiled, by Spark).

* ``note``: join several text columns with a blank, NULLs skipped, ``""`` kept.
* ``word_tokens``: lower-cased runs of Unicode letters, digits and ``_``.
* ``treebank_tokens``: the Penn Treebank word rules as a chain of regex rewrites,
  tokens keep their case, punctuation stays as tokens.

Both tokenisers drop stop words by exact match and keep order and repeats, so
term frequencies stay right (``array_except`` would remove repeats).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop list that ships with Spark ML
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him "
    "his himself she her hers herself it its itself they them their theirs themselves "
    "what which who whom this that these those am is are was were be been being have "
    "has had having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when "
    "where why how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now i'll you'll he'll she'll "
    "we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't "
    "hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't "
    "cannot could here's how's let's ought that's there's what's when's where's who's "
    "why's would"
).split()

# Whitespace shared by every rule: exactly the characters Python's ``str.isspace``
# accepts (the whitespace of the original Python tokeniser): the ASCII controls
# \t-\r and \x1c-\x1f, space, NEL and the Unicode separators \p{Z}. The same
# class text works in Java and RE2 (a test checks it against ``str.isspace``).
WS_CLASS_BODY = "\\t-\\r\\x{1c}-\\x{20}\\x{85}\\p{Z}"
WS = "[" + WS_CLASS_BODY + "]"
NON_WS = "[^" + WS_CLASS_BODY + "]"

# Word characters of the word tokeniser: Unicode letters, digits and underscore
# (the meaning of a Unicode ``\w``).
WORD_PATTERN = "[\\p{L}\\p{N}_]+"

# The Penn Treebank word-tokenisation rules (published sed script, as
# later packaged by NLTK's TreebankWordTokenizer), in application order.
# Each entry is (pattern, replacement) with ``\1``-style group references; the
# padding step is the marker "PAD". All rules apply globally.
_CONTRACTION_REPL = " \\1 \\2 "
TREEBANK_RULES: tuple[tuple[str, str], ...] = (
    # starting quotes
    ('^"', "``"),
    ("(``)", " \\1 "),
    ("([ (\\[{<])(\"|'')", "\\1 `` "),
    # punctuation
    ("([:,])([^\\p{Nd}])", " \\1 \\2"),
    ("([:,])\\n?\\z", " \\1 "),
    ("\\.\\.\\.", " ... "),
    ("([;@#$%&])", " \\1 "),
    ("([^.])(\\.)([\\])}>\"']*)" + WS + "*\\z", "\\1 \\2\\3 "),
    ("([?!])", " \\1 "),
    ("([^'])' ", "\\1 ' "),
    # brackets and dashes
    ("([\\]\\[(){}<>])", " \\1 "),
    ("--", " -- "),
    ("PAD", "PAD"),
    # ending quotes
    ('"', " '' "),
    ("(" + NON_WS + ")('')", "\\1 \\2 "),
    ("([^' ])('[sS]|'[mM]|'[dD]|') ", "\\1 \\2 "),
    ("([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "\\1 \\2 "),
    # contractions (case-insensitive)
    ("(?i)\\b(can)(not)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(d)('ye)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(gim)(me)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(gon)(na)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(got)(ta)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(lem)(me)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(more)('n)\\b", _CONTRACTION_REPL),
    ("(?i)\\b(wan)(na)(" + WS + ")", " \\1 \\2 "),
    ("(?i) ('t)(is)\\b", _CONTRACTION_REPL),
    ("(?i) ('t)(was)\\b", _CONTRACTION_REPL),
)


# Word characters for the contraction rules' word boundaries: Unicode letters,
# digits and underscore (Python's Unicode ``\w``). ``\b`` differs between
# engines (Java's is Unicode-aware, RE2's is ASCII), so every ``\b`` of a rule is
# rewritten as a captured non-word character (or text edge) that the replacement
# puts back; because such a character is consumed, a directly following
# occurrence can be missed in one pass, so each of these rules is applied twice.
_NON_WORD = "[^\\p{L}\\p{N}_]"


def _shift_refs(repl: str, by: int) -> str:
    out, i = [], 0
    while i < len(repl):
        if repl[i] == "\\" and i + 1 < len(repl) and repl[i + 1].isdigit():
            out.append("\\" + str(int(repl[i + 1]) + by))
            i += 2
        else:
            out.append(repl[i])
            i += 1
    return "".join(out)


def _explicit_boundaries(pattern: str, repl: str) -> tuple[str, str]:
    flags = "(?i)" if pattern.startswith("(?i)") else ""
    body = pattern[len(flags):]
    if body.startswith("\\b"):
        body = "(^|" + _NON_WORD + ")" + body[2:]
        repl = "\\1" + _shift_refs(repl, 1)
    if body.endswith("\\b"):
        groups = sum(1 for i, ch in enumerate(body) if ch == "(" and not body.startswith("(?", i))
        body = body[:-2] + "(" + _NON_WORD + "|\\z)"
        repl = repl + "\\" + str(groups + 1)
    return flags + body, repl


def treebank_steps() -> list[tuple[str, str]]:
    """The rewrite steps actually applied: TREEBANK_RULES with explicit word
    boundaries in the contraction rules (each of those applied twice)."""
    steps: list[tuple[str, str]] = []
    for pattern, repl in TREEBANK_RULES:
        if "\\b" in pattern:
            step = _explicit_boundaries(pattern, repl)
            steps.extend([step, step])
        else:
            steps.append((pattern, repl))
    return steps


def java_replacement(repl: str) -> str:
    """``\\1`` group references -> Java ``$1`` (the only form the rules use)."""
    out = []
    i = 0
    while i < len(repl):
        ch = repl[i]
        if ch == "\\" and i + 1 < len(repl) and repl[i + 1].isdigit():
            out.append("$" + repl[i + 1])
            i += 2
            continue
        if ch == "$":
            out.append("\\$")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def note(*cols: Column | str) -> Column:
    """``concat_ws(' ', ...)``: NULL parts are skipped, empty strings are kept."""
    return F.concat_ws(" ", *[_as_col(c) for c in cols])


def drop_stop_words(tokens: Column, stop_words: Iterable[str] | None = STOP_WORDS_EN) -> Column:
    """Remove stop words (exact, case-sensitive) keeping order and repeats."""
    words = list(stop_words or [])
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def word_tokens(text: Column | str, stop_words: Iterable[str] | None = STOP_WORDS_EN) -> Column:
    """Lower-case, extract runs of letters/digits/underscore, drop stop words."""
    raw = F.regexp_extract_all(F.lower(_as_col(text)), F.lit(WORD_PATTERN), 0)
    return drop_stop_words(raw, stop_words)


# How Spark applies the rules: the same texts as ``treebank_steps`` gives, with less work.
# Rules that only put blanks around fixed strings are plain replacements.
_REPLACED: dict[str, tuple[tuple[str, str], ...]] = {
    "(``)": (("``", " `` "),),
    "\\.\\.\\.": (("...", " ... "),),
    "([;@#$%&])": tuple((c, f" {c} ") for c in ";@#$%&"),
    "([?!])": tuple((c, f" {c} ") for c in "?!"),
    "([\\]\\[(){}<>])": tuple((c, f" {c} ") for c in "][(){}<>"),
    "--": (("--", " -- "),),
    '"': (('"', " '' "),),
}
# Rules that begin with any character: the same matches, found from their fixed character
# on. The character before is looked at but not consumed; it is no blank, which all matches
# but the last end with, so no two matches ever share it.
_FROM_FIXED: dict[str, tuple[str, str]] = {
    "([^.])(\\.)([\\])}>\"']*)" + WS + "*\\z": ("\\.(?<=[^.]\\.)([\\])}>\"']*)" + WS + "*\\z", " .\\1 "),
    "([^' ])('[sS]|'[mM]|'[dD]|') ": ("'(?<=[^' ]')([sSmMdD]?) ", " '\\1 "),
    "([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ": (
        "('(?<=[^' ]')(?:ll|LL|re|RE|ve|VE)|n(?<=[^' ]n)'t|N(?<=[^' ]N)'T) ", " \\1 "),
}
# Strings of which a text must hold one, or end with one, for a rule to match: a substring
# test in front of the regex.
_RULE_NEEDLES: dict[str, tuple[str, ...]] = {
    '^"': ('"',),
    "([ (\\[{<])(\"|'')": ('"', "''"),
    "([^'])' ": ("' ",),
    "(" + NON_WS + ")('')": ("''",),
    "([^' ])('[sS]|'[mM]|'[dD]|') ": ("'",),
    "([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ": ("'",),
}
_RULE_ENDS: dict[str, tuple[str, ...]] = {"([:,])\\n?\\z": (":", ",", ":\n", ",\n")}
# The same for the contraction rules, in the lower-cased text before any of them (they only
# put in blanks, and no needle holds one).
_CONTRACTION_NEEDLES = ("cannot", "d'ye", "mme", "gonna", "gotta", "mme", "more'n", "wanna", "'t", "'t")


def spark_steps() -> tuple[list[tuple], list[tuple[str, list[tuple[str, str]]]]]:
    """What Spark does for ``treebank_steps``: (rewrites, contractions).

    A rewrite is ("pad",), ("replace", string, by) or ("regex", pattern, replacement,
    needles, ends); a contraction is (needle, its regex steps).
    """
    rewrites: list[tuple] = []
    contractions = []
    for pattern, repl in TREEBANK_RULES:
        if pattern == "PAD":
            rewrites.append(("pad",))
        elif pattern in _REPLACED:
            rewrites.extend(("replace", a, b) for a, b in _REPLACED[pattern])
        elif pattern.startswith("(?i)"):
            step = _explicit_boundaries(pattern, repl) if "\\b" in pattern else (pattern, repl)
            contractions.append((_CONTRACTION_NEEDLES[len(contractions)], [step] * (2 if "\\b" in pattern else 1)))
        else:
            rewrites.append(("regex", *_FROM_FIXED.get(pattern, (pattern, repl)),
                             _RULE_NEEDLES.get(pattern, ()), _RULE_ENDS.get(pattern, ())))
    return rewrites, contractions


def _rewrite(col: Column, pattern: str, repl: str) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(java_replacement(repl)))


def _let(col: Column, body) -> Column:
    """``body(x)`` with ``x`` bound to ``col`` (a lambda variable, so ``body`` may
    use it several times without copying the expression tree of ``col``)."""
    return F.element_at(F.transform(F.array(col), body), 1)


def _guarded(pattern: str, repl: str, needles: Iterable[str], ends: Iterable[str]):
    def body(x: Column) -> Column:
        tests = [x.contains(n) for n in needles] + [x.endswith(n) for n in ends]
        return F.when(reduce(or_, tests), _rewrite(x, pattern, repl)).otherwise(x)
    return body


def _contracted(low: Column, needle: str, steps: Iterable[tuple[str, str]]):
    def body(x: Column) -> Column:
        done = x
        for pattern, repl in steps:
            done = _rewrite(done, pattern, repl)
        return F.when(low.contains(needle), done).otherwise(x)
    return body


def treebank_text(text: Column | str) -> Column:
    """Apply the Treebank rewrite chain; the result is blank-separated tokens."""
    out = _as_col(text)
    rewrites, contractions = spark_steps()
    for kind, *step in rewrites:
        if kind == "pad":
            out = F.concat(F.lit(" "), out, F.lit(" "))
        elif kind == "replace":
            out = F.replace(out, F.lit(step[0]), F.lit(step[1]))
        else:
            pattern, repl, needles, ends = step
            out = _let(out, _guarded(*step)) if needles or ends else _rewrite(out, pattern, repl)

    def contract(x):
        def within(low):
            y = x
            for needle, steps in contractions:
                y = _let(y, _contracted(low, needle, steps))
            return y
        return _let(F.lower(x), within)
    return _let(out, contract)


def treebank_tokens(text: Column | str, stop_words: Iterable[str] | None = STOP_WORDS_EN) -> Column:
    """Treebank tokens (case kept) minus stop words, order and repeats kept."""
    pieces = F.split(treebank_text(text), WS + "+")
    words = list(stop_words or [])
    if not words:
        return F.filter(pieces, lambda t: t != F.lit(""))
    # One pass: drop the empty pieces at both ends and the stop words.
    return F.filter(pieces, lambda t: (t != F.lit("")) & ~t.isin(words))


TOKENIZERS = {"words": word_tokens, "treebank": treebank_tokens}
