"""Text kernel: folding, term matching with evidence, excerpts. Everything is Column -> Column."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as text feeds know it, the no-break space included.
SPACE = r"(?U)\s+"


#: The first of the syllables that decompose by rule, and how many there are.
_HANGUL, _SYLLABLES = 0xAC00, 11172


def _plain(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not 0x300 <= ord(x) <= 0x36F)


def _fold_map() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition is one character, those characters, and the others with theirs."""
    src, dst, gone, many = [], [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF or _HANGUL <= code < _HANGUL + _SYLLABLES:
            continue
        c, base = chr(code), _plain(chr(code))
        if len(base) == 1 and base != c:
            src.append(c)
            dst.append(base)
        elif not base:
            gone.append(c)
        elif base != c:
            many[c] = base
    return "".join(src + gone), "".join(dst), many


_SRC, _DST, _MANY = _fold_map()


def _jamo(first: int, n: int) -> Column:
    return F.lit("".join(chr(first + i) for i in range(n)))


def _tables() -> list[tuple[int, int, str]]:
    """Blocks of neighbouring characters that become several: first and last code point, and the block as a literal map."""
    blocks: list[list[int]] = []
    for code in sorted(map(ord, _MANY)):
        if blocks and code - blocks[-1][-1] < 96:
            blocks[-1].append(code)
        else:
            blocks.append([code])
    return [(b[0], b[-1], "\x01".join(f"{chr(k)}\x02{_MANY[chr(k)]}" for k in b)) for b in blocks]


_TABLES = _tables()


def _ranges() -> str:
    """The characters that ``one`` changes, as ranges of a pattern: curly quotes, dashes and other scripts' letters are not among them."""
    ranges: list[list[int]] = [[_HANGUL, _HANGUL + _SYLLABLES - 1]]
    for code in sorted(map(ord, _MANY)):
        if code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def _decomposed(c: Column) -> Column:
    """Compatibility forms taken apart, marks dropped: single ones by translation, the others looked up in texts that hold one.

    Most texts are plain ASCII after the translation, which two lengths tell.
    """
    least = min(_MANY)

    def one(x: Column) -> Column:
        code = F.ascii(x)
        at = code - _HANGUL
        place = lambda jamo, i: F.substr(jamo, i.cast("int") + 1, F.lit(1))
        parts = F.concat(place(_jamo(0x1100, 19), F.floor(at / 588)), place(_jamo(0x1161, 21), F.floor(at % 588 / 28)), F.when(at % 28 > 0, place(_jamo(0x11A8, 27), at % 28 - 1)).otherwise(""))
        out = F.when(x < least, x).when((at >= 0) & (at < _SYLLABLES), parts)
        for first, last, pairs in _TABLES:
            out = out.when((code >= first) & (code <= last), F.coalesce(F.try_element_at(F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02")), x), x))
        return out.otherwise(x)

    kind = rf"(?=[^\x00-\x7f])[{_ranges()}]"

    def whole(t: Column) -> Column:
        return F.when(F.octet_length(t) == F.length(t), t).when(t.rlike(kind), F.array_join(F.transform(F.split(t, ""), one), "")).otherwise(t)

    # the lambda binds the translation, which would be made anew wherever it is named
    return F.get(F.transform(F.array(F.translate(c, _SRC, _DST)), whole), F.lit(0))


def bind(df: DataFrame, **values: Column) -> DataFrame:
    """Columns computed once a row, however often they are used later.

    A generator of one row holds them; a projection would be copied into every filter that is pushed below it.
    """
    return df.select("*", F.explode(F.array(F.struct(*[v.alias(n) for n, v in values.items()]))).alias("__b")).select(*df.columns, *[F.col(f"__b.{n}").alias(n) for n in values])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` names it within lambdas."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def has_text(c: Column) -> Column:
    return c.isNotNull() & (F.btrim(c) != "")


def unique_texts(values: Column) -> Column:
    """The texts of an array, trimmed, without blank ones, each once in the order of its first place; null is an empty array."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.btrim(v)), lambda v: F.coalesce(v != "", F.lit(False))))


def first_text(*cols: Column) -> Column:
    """The first non-blank value, trimmed, else ''."""
    return F.coalesce(*[F.nullif(F.btrim(c), F.lit("")) for c in cols], F.lit(""))


def fold_loose(c: Column) -> Column:
    """Entities decoded (the ampersand first), compatibility forms and accents folded, lower case, white space collapsed.

    Marks of other scripts keep the order in which they stand.
    """
    for coded, raw in (("&amp;", "&"), ("&quot;", '"'), ("&#39;", "'")):
        c = F.replace(c, F.lit(coded), F.lit(raw))
    return F.btrim(F.regexp_replace(F.lower(_decomposed(c)), SPACE, " "))


def fold_search(c: Column) -> Column:
    """``fold_loose`` with everything but a-z and 0-9 turned into single spaces."""
    return F.btrim(F.regexp_replace(fold_loose(c), "[^a-z0-9]+", " "))


def plain_fold(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), SPACE, " "))


def title_key(title: Column, source: Column | None = None) -> Column:
    """Key under which titles count as duplicates."""
    t = title if source is None else strip_suffix(title, media_name(source))
    return F.btrim(F.regexp_replace(fold_loose(t), r"[^\p{L}\p{N}]+", " "))


def padded(c: Column) -> Column:
    return F.concat(F.lit(" "), c, F.lit(" "))


def fold_term(term: str) -> str:
    """A term as ``fold_search`` would leave it."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", term) if not 0x300 <= ord(c) <= 0x36F).lower()
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in plain).split())


def fold_term_loose(term: str) -> str:
    """A term as ``fold_loose`` would leave it."""
    return " ".join("".join(c for c in unicodedata.normalize("NFKD", term) if not 0x300 <= ord(c) <= 0x36F).lower().split())


def unique_terms(terms) -> list[str]:
    """The first term of each folded form; terms that fold to nothing are left out."""
    out: dict[str, str] = {}
    for t in terms:
        if k := fold_term(t):
            out.setdefault(k, t)
    return list(out.values())


def contains_term(folded: Column, term: str) -> Column:
    """Whole-token containment in text folded by ``fold_search``; a blank term matches nothing."""
    term = fold_term(term)
    return padded(folded).contains(f" {term} ") if term else F.lit(False)


def any_term(folded: Column, terms) -> Column:
    return reduce(lambda a, b: a | b, [contains_term(folded, t) for t in terms], F.lit(False))


def boundary_term(loose: Column, term: str) -> Column:
    """Unicode word-boundary match in text folded by ``fold_loose``; punctuation within the term counts."""
    import re

    return loose.rlike(rf"(^|[^\p{{L}}\p{{N}}]){re.escape(fold_term_loose(term))}([^\p{{L}}\p{{N}}]|$)")


def raw_contains(c: Column, key: str, pad: bool = True) -> Column:
    """Substring match in lower-cased text, which may hit within words."""
    low = F.lower(c)
    return (padded(low) if pad else low).contains(key)


def ordered_context(folded: Column, leads, actions) -> Column:
    """Some lead term and, later, some action term."""
    lead, action = ["|".join(filter(None, map(fold_term, terms))) for terms in (leads, actions)]
    return padded(folded).rlike(f" (?:{lead}) (?:.* )?(?:{action}) ") if lead and action else F.lit(False)


def matched_terms(folded: Column, terms, match=contains_term) -> Column:
    """The terms that occur, in the order given."""
    return F.array_compact(F.array(*[F.when(match(folded, t), F.lit(t)) for t in terms])) if terms else F.array().cast("array<string>")


def grouped_terms(folded: Column, groups: dict[str, list[str]], match=contains_term) -> Column:
    """Terms of all groups that occur, once each, in sorted order."""
    return matched_terms(folded, sorted({t for g in groups.values() for t in g}), match)


def window_excerpt(c: Column, at: Column, whole: int, before: int) -> Column:
    """The whole text up to ``whole`` characters, else that many from ``before`` characters ahead of ``at`` (1-based, 0: none)."""
    start = F.greatest(at - 1 - before, F.lit(0)) + 1
    return F.when(F.length(c) <= whole, c).otherwise(c.substr(start, F.lit(whole)))


def evidence_excerpt(title: Column, terms) -> Column:
    """Excerpt around the first listed term that occurs."""
    at = F.coalesce(*[F.nullif(F.locate(t.lower(), F.lower(title)), F.lit(0)) for t in terms], F.lit(0))
    return window_excerpt(title, at, 220, 60)


def field_excerpt(value: Column, term: str) -> Column:
    return window_excerpt(value, F.locate(term.lower(), F.lower(value)), 300, 100)


def matched_evidence(fields: dict[str, Column], terms, folded: dict[str, Column] | None = None) -> Column:
    """Structs (term, field, excerpt), term by term and then field by field; ``folded`` gives the fields folded before."""
    of = folded or {n: fold_search(c) for n, c in fields.items()}
    hits = [
        F.when(contains_term(of[n], t), F.struct(F.lit(t).alias("term"), F.lit(n).alias("field"), field_excerpt(c, t).alias("excerpt"))) for t in terms for n, c in fields.items()
    ]
    return F.array_compact(F.array(*hits))


def media_name(source: Column) -> Column:
    """What stands in brackets at the end of a source name."""
    return F.regexp_extract(source, r"\(([^)]+)\)\s*$", 1)


def strip_suffix(title: Column, media: Column) -> Column:
    """Drop trailing `` - tail`` parts that are a URL, a domain or the media's name."""
    tail = F.concat(
        F.lit(r"(?:\s* - \s*(?:https?://\S+|[A-Za-z0-9.\-]+\.[a-z]{2,}"), F.when(media != "", F.concat(F.lit(r"|(?i:\Q"), media, F.lit(r"\E)"))).otherwise(F.lit("")), F.lit(r"))+\s*$")
    )
    return F.btrim(F.regexp_replace(title, tail, F.lit("")))


def shorten_spaceless(title: Column, most: int = 80) -> Column:
    return F.when((F.length(title) > most) & ~title.contains(" "), F.concat(F.substring(title, 1, most), F.lit("[...]"))).otherwise(title)
