"""JSON text as column expressions: escaping, quoting and the validity gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two-character escapes; the backslash must be replaced first.
SHORT_ESCAPES = [
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
]

# Printable ASCII without quote and backslash: the common case, and always valid.
_PLAIN = r"^[\x20\x21\x23-\x5b\x5d-\x7e]*+\z"
_NEEDS_ESCAPE = r'[\x00-\x1f"\\\x7f]'
_NEEDS_LONG_ESCAPE = r"[\x00-\x07\x0b\x0e-\x1f\x7f]"

# Parsers inside Spark refuse very long strings and numbers. These two patterns
# shorten valid literals without changing whether the whole text is valid.
_STRING_LITERAL = (
    r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
)
_LONG_DIGITS = r"(\d)\d{300,}+"
_PARSER_LIMIT = 1000

# Fixed value: nesting beyond this depth is refused by the format's own gate.
_DEEPEST = 10_000

# Innermost containers of a text whose strings are all empty: only scalars inside.
_WS = r"[ \t\n\r]*+"
_SCALAR = r'(?:""|true|false|null|-?+(?:0|[1-9]\d*+)(?:\.\d++)?+(?:[eE][+-]?+\d++)?+)' + _WS
_FIELD = f'""{_WS}:{_WS}{_SCALAR}'
_INNERMOST = (
    rf"\[{_WS}(?:{_SCALAR}(?:,{_WS}{_SCALAR})*+)?+\]|\{{{_WS}(?:{_FIELD}(?:,{_WS}{_FIELD})*+)?+\}}"
)


def _replace_all(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _control(char: Column) -> Column:
    """Any control character or DEL as lower-case backslash-u, others as they are."""
    code = F.ascii(char)
    digits = F.lpad(F.lower(F.hex(code)), 4, "0")
    return F.when((code < 0x20) | (code == 0x7F), F.concat(F.lit("\\u"), digits)).otherwise(char)


def json_escape(text: Column) -> Column:
    """Escape text for use inside a JSON string; other UTF-8 passes through."""
    valid = F.make_valid_utf8(text)
    short = _replace_all(valid, SHORT_ESCAPES)
    long = F.array_join(
        F.transform(F.regexp_extract_all(short, F.lit("(?s)."), F.lit(0)), _control), ""
    )
    return (
        F.when(text.rlike(_PLAIN), text)
        .when(~valid.rlike(_NEEDS_ESCAPE), valid)
        .when(~valid.rlike(_NEEDS_LONG_ESCAPE), short)
        .otherwise(long)
    )


def bare_quote(text: Column) -> Column:
    """Quote text that is known to need no escape."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def json_quote(text: Column) -> Column:
    return F.concat(F.lit('"'), json_escape(text), F.lit('"'))


def _parses(text: Column) -> Column:
    # The variant parser is strict but stops after the first value; the array
    # length is lenient but sees trailing text. Together they are exact.
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(F.try_parse_json(text).isNotNull() & one, F.lit(False))


def _depth(text: Column) -> Column:
    """Deepest nesting of brackets in a text without strings."""
    steps = F.split(F.regexp_replace(text, F.lit(r"[^\[\]{}]"), F.lit("")), "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, char: Column) -> Column:
        change = F.when(char.isin("[", "{"), 1).when(char.isin("]", "}"), -1).otherwise(0)
        now = state["now"] + change
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(steps, start, step, lambda state: state["most"])


def _flattened(text: Column) -> Column:
    """The text with its deepest levels, where valid, put down to numbers.

    One pass takes one level; the blanks keep neighbours from growing together.
    """
    levels = F.least(_depth(text), F.lit(_DEEPEST + 1)) - _PARSER_LIMIT // 2
    passes = F.when(levels > 0, F.sequence(F.lit(1), levels))
    return F.when(
        levels <= _DEEPEST - _PARSER_LIMIT // 2,
        F.aggregate(passes, text, lambda t, _: F.regexp_replace(t, F.lit(_INNERMOST), F.lit(" 0 "))),
    )


def is_valid_json(text: Column) -> Column:
    """True when the text is exactly one strict JSON value (false for null).

    Literals beyond the parser's own size limits are shortened and levels beyond
    its nesting limit are folded, then it is tried again, so long and deep texts
    are judged whole. Nesting deeper than 10,000 is invalid.
    """
    shortened = F.regexp_replace(text, F.lit(_STRING_LITERAL), F.lit('""'))
    shortened = F.regexp_replace(shortened, F.lit(_LONG_DIGITS), F.lit("$11"))
    brackets = F.length(F.regexp_replace(shortened, F.lit(r"[^\[{]"), F.lit("")))
    return (
        _parses(text)
        | (F.coalesce(F.length(text) > _PARSER_LIMIT, F.lit(False)) & _parses(shortened))
        | (F.coalesce(brackets > _PARSER_LIMIT // 2, F.lit(False)) & _parses(_flattened(shortened)))
    )
