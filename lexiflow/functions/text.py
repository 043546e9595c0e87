"""String, array and map expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import (ACCENTS, CAPITALS, CYRILLIC, JUNK_CHANGED, ORTHOGRAPHIES, alternation,
                    rewrite_maps)

# Markers of the character formats (fixed values).
WORD_BEGIN, WORD_END = "<w>", "<\\w>"
SPACE_MARK = "_"
SEQ_BEGIN, SEQ_END = "<s>", "</s>"
MISSING = "%"
MED_END = "</S>"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def computed(df: DataFrame, keep: Sequence[str], **cols: Column) -> DataFrame:
    """``keep`` and the named ``cols``, each computed once a row. The optimizer copies
    the expressions of a projection into every filter above it; the output of a
    generator (here of one struct a row) it reads by name."""
    d = df.select(*keep, *[c.alias(name) for name, c in cols.items()])
    rest = [c for c in d.columns if c not in cols]
    return d.select(*rest, F.inline(F.array(F.struct(*cols))))


def once(c: Column) -> Column:
    """``c``, not made again by filters above its projection (they are not pushed below
    what is no function of the row), and dropped where nothing reads it."""
    return F.when(F.spark_partition_id() >= 0, c)


# ----------------------------------------------------------------- T1, T2

def _translate_pairs() -> tuple[str, str]:
    src, dst = [], []
    for table in (ACCENTS, CYRILLIC, JUNK_CHANGED, CAPITALS):
        for a, b in table:
            if len(a) == 1 and len(b) == 1 and a != b and a not in src:
                src.append(a)
                dst.append(b)
    return "".join(src), "".join(dst)


PRECLEAN_FROM, PRECLEAN_TO = _translate_pairs()
PRECLEAN_MULTI = [(a, b) for t in (CAPITALS,) for a, b in t if len(a) > 1]


def preclean(c: Column) -> Column:
    """Lower-case; accented vowels to plain ones, Cyrillic look-alikes to
    Latin, curly quotes to ``'``, odd spaces to a space."""
    for a, b in PRECLEAN_MULTI:
        c = F.replace(c, F.lit(a), F.lit(b))
    c = F.translate(c, PRECLEAN_FROM, PRECLEAN_TO)
    return F.translate(F.lower(c), PRECLEAN_FROM, PRECLEAN_TO)


def _map_literal(m: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for k in sorted(m) for x in (k, m[k])])


def _rewrite_pieces(s: Column, m: dict[str, str]) -> Column:
    """One simultaneous leftmost-longest pass: split s into the longest known
    pieces (any other character alone), map each piece (null: unknown).

    A one-character piece is looked up by its position in a string of all
    one-character keys (one native ``instr``) and indexes a literal array of
    replacements; only multi-character pieces use a (small) literal map."""
    pieces = F.regexp_extract_all(s, F.lit(alternation(m.keys())), 0)
    singles = sorted(k for k in m if len(k) == 1)
    keys1 = "".join(singles)
    vals1 = F.array(*[F.lit(m[k]) for k in singles])
    multi = _map_literal({k: v for k, v in m.items() if len(k) > 1})

    def look(x):
        return F.when(F.length(x) == 1, F.get(vals1, F.instr(F.lit(keys1), x) - 1)) \
                .otherwise(F.try_element_at(multi, x))
    return F.transform(pieces, look)


def normalise_with(c: Column, orth: str) -> Column:
    """T1 for one orthography: two passes; if a character is outside the
    orthography's alphabet the rewrite fails and the raw form is kept."""
    first, full = rewrite_maps(orth)

    def joined(pieces: Column, use) -> Column:
        """``use`` of the rewritten text, null where a piece is unknown; the pieces are cut once."""
        return let(pieces, lambda p: F.when(F.forall(p, lambda v: v.isNotNull()), use(F.array_join(p, ""))))
    return F.coalesce(joined(_rewrite_pieces(c, first), lambda o1: joined(_rewrite_pieces(o1, full), lambda o2: o2)), c)


def rewriter(orth: str):
    """``normalise_with`` as a Python function of one form."""
    steps = [(re.compile(alternation(m)).findall, m.get) for m in rewrite_maps(orth)]

    def rewrite(form: str) -> str:
        out = form
        for cut, known in steps:
            pieces = list(map(known, cut(out)))
            if None in pieces:
                return form
            out = "".join(pieces)
        return out
    return rewrite


def normalise(c: Column, orthography: Column) -> Column:
    """Rewrite with the rule set chosen per row by ``orthography``; a form of an unknown
    set stays. Equal forms are rewritten once, and not again in filters above."""
    memos = {}

    def forms(form, orth):
        import pyarrow as pa

        from ..sources.markup import Memo, strings

        if not memos:
            memos.update({o: Memo(rewriter(o)) for o in ORTHOGRAPHIES})
        pairs = zip(strings(form), strings(orth))
        return pa.array([memos[o][f] if f is not None and o in memos else f for f, o in pairs], pa.string())
    return F.arrow_udf(forms, "string", F.ArrowUDFType.SCALAR).asNondeterministic()(c, orthography)


def orthography_of_text(text_id: Column) -> Column:
    """The rule set of a text: characters 5-8 of its id (``1897LENZ-11`` -> LENZ)."""
    return F.substring(text_id, 5, 4)


# ------------------------------------------------------------ T3, T4, T5

def chars(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>"))


def to_chars(token: Column) -> Column:
    """``<w> c h a r <\\w>``."""
    return F.concat_ws(" ", F.lit(WORD_BEGIN), F.array_join(chars(token), " "), F.lit(WORD_END))


def from_chars(line: Column) -> Column:
    """T4: drop the first and last symbol, join the rest, ``_`` back to a space."""
    syms = F.split(F.trim(line), " +")
    inner = F.slice(syms, 2, F.greatest(F.size(syms) - 2, F.lit(0)))
    return F.translate(F.array_join(inner, ""), SPACE_MARK, " ")


def levenshtein(a: Column, b: Column) -> Column:
    """T5: character edit distance."""
    return F.levenshtein(a, b)


# ------------------------------------------------------------ T6 - T10

def parse_feats(c: Column) -> Column:
    """``k=v,k=v`` -> map (a repeated key keeps the last value)."""
    return F.str_to_map(c, F.lit(","), F.lit("="))


def morph_string(feats: Column, keys: Column) -> Column:
    """All known feature types in sorted order, ``k=v`` joined by ``:``,
    ``%`` for a missing value. ``keys`` is an array column of feature names."""
    return F.array_join(F.transform(F.array_sort(keys), lambda k: F.concat(
        k, F.lit("="), F.coalesce(F.try_element_at(feats, k), F.lit(MISSING)))), ":")


def sort_feats(c: Column, sep: str = ",") -> Column:
    """Sort the features inside a bundle."""
    return F.array_join(F.array_sort(F.split(c, sep)), sep)


def _spaced(c: Column) -> Column:
    return F.array_join(chars(c), " ")


def to_morphtrans(lemma: Column, word: Column, morph: Column) -> Column:
    """``<s> l e m m a </s>|<s> w o r d </s>|morph-string``."""
    return F.concat(F.lit(SEQ_BEGIN + " "), _spaced(lemma), F.lit(" " + SEQ_END + "|" + SEQ_BEGIN + " "),
                    _spaced(word), F.lit(" " + SEQ_END + "|"), morph)


def from_morphtrans(line: Column) -> Column:
    """T9 back: struct(lemma, prediction, feats): markers and spaces removed,
    features with ``%`` dropped, the rest sorted and comma-joined. Callers drop
    ``GOLD`` lines."""
    parts = F.split(line, r"\|")

    def clean(x: Column) -> Column:
        for tok in (SEQ_BEGIN, SEQ_END, "PRED:"):
            x = F.replace(x, F.lit(tok), F.lit(""))
        return F.trim(F.replace(x, F.lit(" "), F.lit("")))
    fs = F.filter(F.split(F.replace(F.trim(F.get(parts, 2)), F.lit(":"), F.lit(",")), ","),
                  lambda f: ~f.contains(MISSING))
    return F.struct(clean(F.get(parts, 0)).alias("lemma"), clean(F.get(parts, 1)).alias("prediction"),
                    F.array_join(F.array_sort(fs), ",").alias("feats"))


def to_med(lemma: Column, feats: Column, word: Column) -> Column:
    """Encoder input ``k=v ... c h a r s`` (features in key order) and the
    spaced target. Returns struct(source, target)."""
    kv = F.transform(F.array_sort(F.map_entries(feats)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    src = F.array_join(F.concat(kv, chars(lemma)), " ")
    return F.struct(src.alias("source"), _spaced(word).alias("target"))


def from_med(line: Column) -> Column:
    """T10 back: strip spaces and the end marker."""
    return F.replace(F.replace(line, F.lit(" "), F.lit("")), F.lit(MED_END), F.lit(""))


# -------------------------------------------------------------------- T12

def instantiate(template: Column, lemma: Column) -> Column:
    """Integers copy the lemma character at that index (out of range:
    nothing), anything else is a literal."""
    n = F.length(lemma)

    def piece(x: Column) -> Column:
        is_int = x.rlike(r"^[0-9]+$")
        idx = F.when(is_int & (F.length(x) <= 9), x.cast("int"))
        return F.when(is_int, F.when(idx < n, F.substring(lemma, idx + 1, 1)).otherwise(F.lit(""))).otherwise(x)
    return F.array_join(F.transform(template, piece), "")
