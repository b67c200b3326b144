"""Word tokens that know contractions, quotes and ellipses, as an ordered list of rewrites.

Each rule puts spaces round what is a token of its own; at the end the text is split at white
space. The rules use only what regular expressions of Spark and of other SQL engines read alike: no
look-around, no case folding, explicit white space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r" \t\n\x0b\f\r"
_QUOTE = "['’]"

# Words that are two tokens, written as (first, second).
CONTRACTED = [
    ("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"),
]
# Endings that are tokens of their own after an apostrophe.
ENDINGS = ["s", "m", "d", "ll", "re", "ve"]


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" for c in word)


def _rules() -> list[tuple[str, str]]:
    """(pattern, replacement) in order; ``{1}`` stands for the first group."""
    after = rf"([{_SPACE}\]\[(){{}}<>.,:;!?]|\z)"
    before = rf"(\A|[{_SPACE}\]\[(){{}}<>])"
    rules = [
        # Quotes: opening ones at a beginning or after a space or bracket, the others are closing.
        (rf'{before}["“]', "{1} `` "),
        ('["”]', " '' "),
        ("“", " `` "),
        # An ellipsis is one token, however many dots or as one character.
        (r"(\.\.+|…)", " {1} "),
        (r"([;@#$%&?!])", " {1} "),
        # Commas and colons stay inside numbers.
        (r"([:,])([^0-9])", " {1} {2}"),
        (r"([:,])\z", " {1} "),
        (r"([\]\[(){}<>])", " {1} "),
        (r"(--+)", " {1} "),
        # A dot ends a word of two characters or more before white space or closing quotes; initials keep it.
        (rf"([^{_SPACE}.][^{_SPACE}.])\.([{_SPACE}'’]|\z)", "{1} . {2}"),
        # A single quote that opens; below, one that closes comes after the endings.
        (rf"{before}['‘]([^{_SPACE}'’])", "{1} ` {2}"),
    ]
    rules.append((rf"([nN]){_QUOTE}([tT]){after}", " {1}'{2} {3}"))
    for ending in ENDINGS:
        rules.append((rf"([^{_SPACE}'’]){_QUOTE}({_any_case(ending)}){after}", "{1} '{2} {3}"))
    for first, second in CONTRACTED:
        rules.append((rf"{before}({_any_case(first)})({_any_case(second)}){after}", "{1}{2} {3}{4}"))
    rules.append((rf"([^{_SPACE}'’]){_QUOTE}([{_SPACE}.,:;!?]|\z)", "{1} ' {2}"))
    return rules


RULES = _rules()


def _rewritten(text: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        marked = replacement
        for group in range(1, 5):
            marked = marked.replace(f"{{{group}}}", f"${group}")
        text = F.regexp_replace(text, pattern, marked)
    return text


def contraction_tokens(text: Column) -> Column:
    """Tokens of a text: ``don't`` is ``do n't``, ``it's`` is ``it 's``, ``cannot`` is ``can not``.

    The rules for words that are two tokens come last but one, and add spaces only, so a text that
    holds none of the words by then is looked through once for all of them.
    """
    first = len(RULES) - 1 - len(CONTRACTED)
    words, closing = RULES[first:-1], RULES[-1:]
    held = "|".join(_any_case(a + b) for a, b in CONTRACTED)
    # An array of one, so that the text so far is worked out once.
    parted = F.transform(F.array(_rewritten(text, RULES[:first])), lambda t: F.when(t.rlike(held), _rewritten(t, words)).otherwise(t))
    text = _rewritten(F.element_at(parted, 1), closing)
    return F.filter(F.split(text, f"[{_SPACE}]+"), lambda token: token != "")


def contraction_tokens_sql(text: str) -> str:
    """The same rewrites for DuckDB."""
    for pattern, replacement in RULES:
        for group in range(1, 5):
            replacement = replacement.replace(f"{{{group}}}", f"\\{group}")
        quoted = [part.replace("'", "''") for part in (pattern, replacement)]
        text = f"regexp_replace({text}, '{quoted[0]}', '{quoted[1]}', 'g')"
    return f"list_filter(string_split_regex({text}, '[{_SPACE}]+'), lambda token: token <> '')"
