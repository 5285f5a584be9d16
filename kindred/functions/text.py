"""Text functions on columns. All of them stay in the JVM."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values -----------------------------------------------------------
# Characters a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Punctuation turned into spaces: quotes, brackets and the signs below, then "-" and ".".
PUNCTUATION = "\"'(),;=?@<>[]^`{|}~:+-."

# Tokens longer or shorter than this are dropped.
MIN_TOKEN, MAX_TOKEN = 2, 15

# Characters a valid token may hold.
TOKEN_CHARACTERS = "a-z0-9,.?:;\"'\\[\\]{}=+\\-_)(\\^&$%#@!`~ "

# English stop words.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()
CUSTOM_STOP_WORDS = ["missing", "nobug", "need"]
# -----------------------------------------------------------------------------

STOP_WORDS = ENGLISH_STOP_WORDS + CUSTOM_STOP_WORDS

# A word character in the Unicode sense, spelled out so that Java and RE2 agree.
_W = r"\p{L}\p{N}_"

# The host needs two dotted parts; everything after the second is covered by the
# tail class, so no repeated group is needed and long hosts cannot exhaust the stack.
URL_PATTERN = (
    rf"(?:http|ftp|https)://[{_W}\-]+\.[{_W}\-]+"
    rf"(?:[{_W}.,@?^=%&;:/~+#\-]*[{_W}@?^=%&;/~+#\-])?"
)
# Possessive parts and the look-behind keep long unbroken words linear: a match can
# only start where a run of word characters or dotted words starts.
EMAIL_PATTERN = (
    rf"(?<![{_W}\-])(?<![{_W}\-]\.)[{_W}\-]++(?:\.[{_W}\-]++)*+"
    rf"@[{_W}\-]++(?:\.[{_W}\-]++)++"
)
# (?d): the dot stops at \n only.
PHONE_PATTERN = r"(?d)[@+*].?[014789][0-9+\-.~() ]+.{6,}"

# Every match of the three patterns holds one of these, and so does the text before it is lowered.
_MASKED_SIGNS = ("://", "@", "+", "*")

_PUNCTUATION_CLASS = r"""["'(),;=?@<>\[\]^`{|}~:+\-.]"""
# Allowed characters only, and one of them not a digit: one look at a token.
_VALID_TOKEN = rf"\A[0-9]*+[{TOKEN_CHARACTERS.replace('0-9', '')}][{TOKEN_CHARACTERS}]*+\z"
# Letters and numerals that are not decimal digits, and "_".
_TOKEN_RUN = r"[\p{L}\p{Nl}\p{No}_]+"


def lower_trim(text: Column) -> Column:
    return F.btrim(F.lower(text.cast("string")), F.lit(WHITESPACE))


# Names of characters as HTML 5 lists them; some may stand without their semicolon.
_BARE = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
# Numbers that stand for another character than the one they count: windows-1252, and none for 0x81.
_OF_NUMBER = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
_REFERENCE = "&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{0,31};|(?:%s))" % "|".join(_BARE)


def _constant_map(values: dict[str, str]) -> Column:
    """One literal, folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def _character(number: Column) -> Column:
    """The character of a number, U+FFFD where there is none, nothing for controls and unused numbers."""
    code = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), number).otherwise(0xFFFD)
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    unused = number.between(0xFDD0, 0xFDEF) | (number.between(0, 0x10FFFF) & (number.bitwiseAND(0xFFFE) == 0xFFFE))
    # Four bytes of UTF-32, big end first.
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(control | unused, F.lit("")).otherwise(text)


def decode_entities(text: Column) -> Column:
    """Decodes named, decimal and hexadecimal character references, once each and from left to right.

    Names without a semicolon are decoded where HTML 5 allows that; unknown names stay as they are,
    numbers without a character become U+FFFD, those of controls and unused ones go. Null stays null.
    Everything runs in the JVM.
    """

    def decoded(reference: Column) -> Column:
        name = F.substring(reference, 2, 40)
        digits = F.regexp_extract(name, "^#[xX]?0*([0-9a-fA-F]*)", 1)
        # Numbers of more digits than a character can have stand for none.
        number = F.when(F.length(digits) > 7, F.lit(-1)).otherwise(
            F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        )
        number = F.coalesce(number, F.lit(0))
        numeric = F.coalesce(F.element_at(of_number, number.cast("string")), _character(number))
        # A name that is not known as a whole may begin with one that needs no semicolon.
        bare = F.regexp_extract(name, "^(?:%s)" % "|".join(_BARE), 0)
        begun = F.concat(F.element_at(named, bare), F.substr(name, F.length(bare) + 1))
        return F.when(name.startswith("#"), numeric).otherwise(
            F.coalesce(F.element_at(named, name), begun, reference)
        )

    named, of_number = _constant_map(html5), _constant_map(_OF_NUMBER)
    parts = F.split(text, _REFERENCE)
    found = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), 0), decoded)
    joined = F.array_join(F.zip_with(parts, found, lambda p, f: F.concat(p, F.coalesce(f, F.lit("")))), "")
    return F.when(text.contains("&"), joined).otherwise(text)


def _tags_removed(text: Column, drop_script: bool) -> Column:
    if drop_script:
        text = F.regexp_replace(
            text,
            r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>",
            "",
        )
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"</?[a-zA-Z][^>]*>|<[!?][^>]*>", "")
    # A hard blank written as such is a plain one.
    return decode_entities(F.replace(text, F.lit("&nbsp;"), F.lit(" ")))


def strip_html(text: Column, drop_script: bool = True) -> Column:
    """Text of an HTML fragment: tags are removed, then all character references decoded.

    Then what still looks like a tag goes: after a bare ``<`` everything up to the next ``>``,
    or up to the end when there is none.
    """
    text = _tags_removed(text, drop_script)
    text = F.regexp_replace(text, "<[^>]+>", "")
    text = F.replace(text, F.lit("&nbsp;"), F.lit(" "))
    text = F.regexp_replace(text, "<[^>]+", "")
    return F.regexp_replace(text, "&[lg]t;", " ")


def mask_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, " url ")


def mask_emails(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL_PATTERN, " email ")


def mask_phones(text: Column) -> Column:
    """Greedy on purpose: a number swallows the rest of its line."""
    return F.regexp_replace(text, PHONE_PATTERN, " phone ")


def ascii_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x00-\x7f]", " ")


def space_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, _PUNCTUATION_CLASS, " ")


def _token_length_ok(token: Column) -> Column:
    return F.length(token).between(MIN_TOKEN, MAX_TOKEN) & ~token.startswith("_")


def tokenize(text: Column) -> Column:
    """Runs of non-digit word characters, 2 to 15 long, none starting with ``_``."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(_TOKEN_RUN), 0)
    return F.filter(runs, _token_length_ok)


def remove_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def valid_tokens(tokens: Column) -> Column:
    """Drops tokens with characters outside the allowed set, numbers and single characters."""
    return F.filter(tokens, lambda t: t.rlike(_VALID_TOKEN) & (F.length(t) >= MIN_TOKEN))


def join_tokens(tokens: Column) -> Column:
    """Tokens joined by one space; a single space when there are none."""
    joined = F.array_join(tokens, " ")
    return F.when(joined == "", F.lit(" ")).otherwise(joined)


def clean_tokens(
    text: Column,
    stop_words: Sequence[str] = STOP_WORDS,
    drop_script: bool = True,
) -> Column:
    """Clean tokens of a text, before lemmas.

    After the masks, non-ASCII characters, punctuation and digits only separate tokens,
    and a run of ``[a-z_]`` is always a valid token. One extraction and one filter
    therefore stand for the four steps ascii_only, space_punctuation, tokenize and
    valid_tokens.
    """
    lowered = lower_trim(text)
    # Texts without a tag or an entity skip the markup steps, and the masks where nothing can begin one.
    markup = text.contains("<") | text.contains("&")
    plain = F.when(markup, strip_html(lowered, drop_script)).otherwise(lowered)
    masked = mask_phones(mask_emails(mask_urls(plain)))
    signs = reduce(Column.__or__, (text.contains(sign) for sign in _MASKED_SIGNS), markup)
    runs = F.regexp_extract_all(F.when(signs, masked).otherwise(lowered), F.lit("[a-z_]+"), 0)
    return F.filter(runs, lambda t: _token_length_ok(t) & ~t.isin(list(stop_words)))


def clean_text(text: Column, **options) -> Column:
    return join_tokens(clean_tokens(text, **options))


def light_tokens(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower case, tokens, stop words: no masks and no lemmas."""
    return remove_stop_words(tokenize(lower_trim(text)), stop_words)


def whitespace_tokens(text: Column) -> Column:
    """Tokens between runs of white space, empty ones dropped."""
    return F.filter(F.split(text, f"[{WHITESPACE}]+"), lambda t: t != "")
