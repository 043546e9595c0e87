"""TEI scans (S2-S6) over the markup string.

An XML parser would reject the malformed files of a real corpus and Spark's
``xml`` source separates text from words (losing where punctuation sits), so the
scans work on the string, in document order: in Python tasks for tokens, morphemes and
cells (``markup``), in expressions for the rest. Comments go first. Paragraphs are
cut by one pattern that stops at whatever ends a paragraph in HTML. Inside a
paragraph, markup that is only words and morphemes is cut by one pattern too;
anything else (other elements, nested ones of one name, self-closed or unclosed
tags) is split into tag events, and a fold over the events with the name and depth
of the open child finds the paragraph's own children. All patterns are possessive:
they never go back, so a text's length bounds the work.

Every step is row-local: no shuffle, and one document
never leaves the task that read it.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from ..functions.text import normalise, once
from ..functions.text import let as _let
from ..session import configure
from . import markup as M

# Fixed values of HTML: elements whose start ends an open paragraph, further ones
# (among them those of a TEI file) whose end does, and elements without content.
BLOCK_STARTS = ("address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
                "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
                "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th",
                "thead", "title", "tr", "ul")
BLOCK_ENDS = BLOCK_STARTS + ("html", "div1", "text", "tei")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

# Attributes up to the closing ">", which may stand inside quotes.
_ATTRS = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
# words and morphemes go by without trying the block names
PARAGRAPH_RE = (rf"(?i)<p(?:\s{_ATTRS})?+>[^<]*+(?:<(?:/?+[wm][\s>]|(?!(?:" + "|".join(BLOCK_STARTS) + r")[\s/>]|/(?:"
                + "|".join(BLOCK_ENDS) + r")[\s>]))[^<]*+)*+")
PARAGRAPH_TAG_RE = rf"^<.(?:\s{_ATTRS})?+>"
ROOT_RE = rf"(?i)<(?:text|html|TEI)(\s{_ATTRS})>"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
CHAR_RE = ENTITY + r"|\S"
# A word and its morphemes without other or nested markup, and text made of these only.
_SIMPLE = r"""(?:\s(?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)?+(?<!/)>"""
_MORPH = rf"<m{_SIMPLE}[^<]*+</m>"
_WORD = rf"<w{_SIMPLE}[^<]*+(?:{_MORPH}[^<]*+)*+</w>"
PLAIN_RE = rf"^[^<]*+(?:{_WORD}[^<]*+)*+\z"
PLAIN_ITEM_RE = rf"{_WORD}|{ENTITY}|\S"
PLAIN_INNER_RE = rf"^[^<]*+(?:{_MORPH}[^<]*+)*+\z"
EVENT_RE = rf"</?[A-Za-z]{_ATTRS}>|<[!?][^>]*+>|[^<]++|<"
PLAIN_MORPH_RE = rf"<m((?:\s{_ATTRS})?+)>([^<]*+)</m>"
TAG_RE = r"<[^>]*>"

#: Events folded at a time: states are copied within a block, results between blocks.
BLOCK = 256


def without_comments(c: Column) -> Column:
    return F.when(c.contains("<!--"), F.regexp_replace(c, COMMENT_RE, "")).otherwise(c)


def _events(markup: Column) -> Column:
    """Tags and the texts between them, in order; a quoted ``>`` in a tag is escaped."""
    def escaped(e):
        inside = F.substring(e, 1, F.length(e) - 1)
        return F.when(e.startswith("<") & (F.instr(inside, ">") > 0), F.concat(F.replace(inside, F.lit(">"), F.lit("&gt;")), F.lit(">"))).otherwise(e)
    return F.transform(F.regexp_extract_all(markup, F.lit(EVENT_RE), 0), escaped)


def _tag_names(events: Column) -> Column:
    """Of each event: ``""`` for text, ``name`` and ``/name`` for tags, ``name/`` for an element
    without content, ``!`` for declarations; lower-cased."""
    def name(e):
        opening = F.lower(F.regexp_extract(e, r"^</?([A-Za-z][^\s/>]*)", 1))
        return (F.when(~e.startswith("<") | (F.length(e) == 1), F.lit(""))
                .when(e.startswith("</"), F.concat(F.lit("/"), opening))
                .when(opening == "", F.lit("!"))
                .when(e.endswith("/>") | opening.isin(*VOID), F.concat(opening, F.lit("/"))).otherwise(opening))
    return F.transform(events, name)


_SPAN = "struct<first:int,last:int>"
_OPEN = f"struct<name:string,depth:int,first:int,at:int,out:array<{_SPAN}>>"
_STATE = f"struct<name:string,depth:int,first:int,out:array<array<{_SPAN}>>>"


def _children(tags: Column, word: str = "w") -> Column:
    """Spans of events (from 0, both ends) that are texts or ``word`` elements and children
    of the fragment: a fold whose state is the open child's name, its depth and start.
    What is open at the end ends after the last event."""
    def span(first, last):
        return F.array(F.struct(first.alias("first"), last.alias("last")).cast(_SPAN))

    none = F.array().cast(f"array<{_SPAN}>")

    def step(s, tag):
        top = s["name"] == ""
        opens = top & (tag != "") & ~tag.startswith("/") & ~tag.endswith("/") & (tag != "!")
        deeper = F.when(top, F.lit(0)).otherwise(
            s["depth"] + F.when(tag == s["name"], 1).when(tag == F.concat(F.lit("/"), s["name"]), -1).otherwise(0))
        found = (F.when(top & ((tag == "") | (tag == word + "/")), span(s["at"], s["at"]))
                 .when(~top & (deeper == 0) & (s["name"] == word), span(s["first"], s["at"])).otherwise(none))
        return F.struct(
            F.when(opens, tag).when(~top & (deeper == 0), F.lit("")).otherwise(s["name"]).alias("name"),
            F.when(opens, F.lit(1)).otherwise(deeper).alias("depth"),
            F.when(opens, s["at"]).otherwise(s["first"]).alias("first"), (s["at"] + 1).alias("at"),
            F.when(F.size(found) > 0, F.concat(s["out"], found)).otherwise(s["out"]).alias("out")).cast(_OPEN)

    def block(s, b):
        start = F.struct(s["name"].alias("name"), s["depth"].alias("depth"), s["first"].alias("first"), (b * BLOCK).alias("at"),
                         none.alias("out")).cast(_OPEN)
        return F.aggregate(F.slice(tags, b * BLOCK + 1, BLOCK), start, step, lambda e: F.struct(
            e["name"].alias("name"), e["depth"].alias("depth"), e["first"].alias("first"),
            F.concat(s["out"], F.array(e["out"])).alias("out")).cast(_STATE))

    begin = F.struct(F.lit("").alias("name"), F.lit(0).alias("depth"), F.lit(0).alias("first"),
                     F.array().cast(f"array<array<{_SPAN}>>").alias("out")).cast(_STATE)
    count = F.ceil(F.size(tags) / BLOCK).cast("int")
    blocks = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(blocks, begin, block, lambda e: F.concat(
        F.flatten(e["out"]), F.when(e["name"] == word, span(e["first"], F.size(tags))).otherwise(none)))


def _element(events: Column, span: Column) -> Column:
    """The markup of an element: its start tag, what it holds, an end tag (also where
    the text has none)."""
    start = events[span["first"]]
    inner = F.array_join(F.slice(events, span["first"] + 2, F.greatest(span["last"] - span["first"] - 1, F.lit(0))), "")
    return F.when(start.endswith("/>"), start).otherwise(F.concat(start, inner, F.lit("</w>")))


def _fold_items(body: Column) -> Column:
    """The paragraph's own characters and words, in order, by the fold over tag events."""
    def items(events):
        def of_tags(tags):
            return F.flatten(F.transform(_children(tags), lambda x: F.when(
                tags[x["first"]] == "", F.regexp_extract_all(events[x["first"]], F.lit(CHAR_RE), 0)).otherwise(
                F.array(_element(events, x)))))
        return _let(_tag_names(events), of_tags)
    return _let(_events(body), items)


def _nested(markup: Column, name: str) -> Column:
    """All ``name`` elements at any depth, in the order of their start tags: start tag and
    the markup up to its own end tag or the end."""
    def of_tags(events, tags):
        def element(i):
            rest = F.slice(tags, i + 2, F.size(tags))
            begin = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")).cast("struct<depth:int,n:int>")

            def step(s, tag):
                depth = s["depth"] + F.when(tag == name, 1).when(tag == "/" + name, -1).otherwise(0)
                return F.when(s["depth"] == 0, s).otherwise(F.struct(
                    depth.alias("depth"), (s["n"] + F.when(depth == 0, 0).otherwise(1)).alias("n")).cast("struct<depth:int,n:int>"))
            inside = F.when(tags[i] == name, F.aggregate(rest, begin, step, lambda s: s["n"])).otherwise(0)
            return F.struct(events[i].alias("tag"), F.array_join(F.slice(events, i + 2, inside), "").alias("body"))
        starts = F.filter(F.transform(tags, lambda t, i: F.when(t.isin(name, name + "/"), i)), lambda i: i.isNotNull())
        return F.transform(starts, element)
    return _let(_events(markup), lambda events: _let(_tag_names(events), lambda tags: of_tags(events, tags)))


def _plain_items(body: Column) -> Column:
    return F.regexp_extract_all(body, F.lit(PLAIN_ITEM_RE), 0)


def _from_byte(c: Column, start: Column | int, length: Column | int = 1 << 30) -> Column:
    """``substring`` by bytes: cuts beside ASCII characters need no count of characters."""
    return F.substring(c.cast("binary"), start if isinstance(start, Column) else F.lit(start),
                       length if isinstance(length, Column) else F.lit(length)).cast("string")


def attr(attrs: Column, name: str, ignore_case: bool = False) -> Column:
    """Value of attribute ``name`` in an attribute string; null when absent or
    empty. The common spelling `` name="`` is cut out with string functions;
    other white space, single quotes, no quotes or another letter case fall back
    to a regular expression."""
    slow = F.regexp_extract(attrs, rf"(?i)(?:^|\s){name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    slow = _let(slow, lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substring(v, 2, F.length(v) - 2)).otherwise(v))
    key = f' {name}="'
    fast = F.substring_index(F.substring_index(attrs, key, -1), '"', 1)
    return _let(F.when(attrs.contains(key), fast).otherwise(slow), lambda v: F.when(v != "", v))


def _split_attr(parts: Column, attrs: Column, name: str) -> Column:
    """``attr`` of an attribute string already split at its double quotes: the value
    stands after the part `` name=``. Any other spelling goes through ``attr``."""
    at = F.array_position(parts, f" {name}=").cast("int")
    return (F.when((at > 0) & (at % 2 == 1), F.nullif(F.get(parts, at), F.lit("")))
            .when(F.lower(attrs).contains(name), attr(attrs, name)))


def _entity_map() -> Column:
    names = [(k, chr(v)) for k, v in sorted(name2codepoint.items())] + [("apos", "'")]
    # one literal: a call for each of 250 names is slow to build
    return F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in names)), F.lit("\n"), F.lit("\t"))


def unescape(c: Column) -> Column:
    """Named (those of HTML 4 and ``apos``) and numeric character references as characters."""
    def piece(p):
        name = F.regexp_extract(p, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7)).try_cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        # code point -> text: four bytes, big end first
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        new = F.when(name.startswith("#"), F.when(valid, char)).when(name != "", F.element_at(_entity_map(), name))
        return F.coalesce(F.concat(new, F.substring(p, F.length(name) + 2, 1 << 30)), F.concat(F.lit("&"), p))

    def whole(parts):
        return F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))
    return _let(c, lambda v: F.when(v.contains("&"), _let(F.split(v, "&", -1), whole)).otherwise(v))


def _unescaped(c: Column) -> Column:
    """``unescape`` of a column read by name: no lambda runs for text without references."""
    return F.when(c.contains("&"), unescape(c)).otherwise(c)


def strip_tags(c: Column) -> Column:
    return F.when(c.contains("<"), F.regexp_replace(c, TAG_RE, "")).otherwise(c)


def _of_distinct(c: Column, kind: str, fn) -> Column:
    """``fn`` of a string column as ``kind``, worked out once for equal values of a batch (``markup.Memo``).
    Not to be computed again in the filters above it, so not declared deterministic."""
    spark_type = DataType.fromDDL(kind)
    arrow_type = to_arrow_type(spark_type)

    memos = {}

    def values(column):
        return M.by_distinct(memos.setdefault("", M.Memo(fn)), column, arrow_type)
    return F.arrow_udf(values, spark_type, F.ArrowUDFType.SCALAR).asNondeterministic()(c)


def tei_paragraphs(docs: DataFrame, lang: str | Sequence[str] | None, key: str = "doc_id",
                   col: str = "xml") -> DataFrame:
    """Every ``<p>`` whose language (its ``xml:lang``, else the document's
    root ``lang``) is in ``lang`` (``None`` = all), numbered from 1 among the kept
    ones, with its ``n`` attribute. Comments are dropped; a paragraph ends at its end
    tag, at the start of a block element, at the end of one around it, or with the
    text. Output (key, par_id, lang, n, body)."""
    docs = docs.select(key, without_comments(F.col(col)).alias("_x"))
    x = F.col("_x")
    tags = F.regexp_extract(x, ROOT_RE, 1)
    # below the generator, so that the text itself is not carried to every paragraph
    docs = docs.select(key, "_x", F.coalesce(attr(tags, "xml:lang"), attr(tags, "lang")).alias("_root"))
    pars = F.regexp_extract_all(x, F.lit(PARAGRAPH_RE), 0)

    def start(p):
        return F.regexp_extract(p, PARAGRAPH_TAG_RE, 0)

    def language(p):
        return F.coalesce(attr(F.substring(start(p), 3, 1 << 30), "xml:lang"), F.col("_root"))
    if lang is not None:
        langs = [lang] if isinstance(lang, str) else list(lang)
        pars = F.filter(pars, lambda p: language(p).isin(*langs))
    out = docs.select(key, "_root", F.posexplode(pars).alias("pos", "p"))
    out = out.select(key, "_root", "pos", "p", start(F.col("p")).alias("_tag"))
    attrs = F.substring("_tag", 3, F.length("_tag") - 3)
    return out.select(key, (F.col("pos") + 1).cast("bigint").alias("par_id"),
                      F.coalesce(attr(attrs, "xml:lang"), F.col("_root")).alias("lang"), attr(attrs, "n").alias("n"),
                      _from_byte(F.col("p"), F.octet_length("_tag") + 1).alias("body"))


def raw_lines(pars: DataFrame, key: str = "doc_id") -> DataFrame:
    """Paragraph text with the tags removed (entities decoded), one line each."""
    return pars.select(key, "par_id", unescape(strip_tags(F.col("body"))).alias("line"))


def tei_tokens(pars: DataFrame, key: str = "doc_id") -> DataFrame:
    """S3: walk the children of each paragraph in order; a ``<w>`` is a word token,
    every non-space character between words is a PUNCT token whose lemma is
    itself. Other elements are passed over with all they hold.
    Tokens are numbered from 1 within the paragraph.

    Output (key, par_id, n, lang, tok_id, form, lemma, xpostag, word_lang, inner, item)."""
    configure(pars.sparkSession)
    d = pars.select(key, "par_id", "n", "lang", "body")
    texts = ("item", "form", "lemma", "xpostag", "own_lang")
    schema = StructType([*d.schema.fields[:-1], StructField("tok_id", LongType()), *(StructField(c, StringType()) for c in texts)])
    names, void = schema.names, frozenset(VOID)
    t = d.mapInArrow(lambda batches: M.token_batches(batches, void, names), schema)
    item = F.col("item")
    # Any other tag was dropped, so a longer item starting with '<' is a word element.
    is_word = item.startswith("<") & (item != "<")
    open_tag = F.substring_index(item, ">", 1)
    inner = F.when(open_tag.endswith("/"), F.lit("")).otherwise(
        _from_byte(item, F.octet_length(open_tag) + 2, F.octet_length(item) - F.octet_length(open_tag) - 5))
    return t.select(
        key, "par_id", "n", "lang", "tok_id", "form", "lemma", "xpostag",
        F.when(is_word, F.coalesce("own_lang", "lang")).alias("word_lang"),
        F.when(is_word, inner).alias("inner"), F.when(is_word, item).alias("item"))


def _morph_structs(inner: Column) -> Column:
    """Text, base form and type of each ``<m>`` of a word, nested ones too."""
    void = frozenset(VOID)
    return _of_distinct(inner, "array<struct<text:string,base_form:string,type:string>>", lambda v: M.morphemes(v, void))


def _morph_fields(inner: Column) -> Column:
    """FEATS (morpheme types minus null and ``root``, ``_`` when none) and the base forms joined."""
    void = frozenset(VOID)
    return _of_distinct(inner, "struct<feats:string,bases:string>", lambda v: M.fields_of(M.morphemes(v, void)))


def morph_types(inner: Column, missing: str) -> Column:
    """Number of a word's morphemes, a comma, and the type of each with a space after it."""
    void = frozenset(VOID)

    def line(v):
        found = M.morphemes(v, void)
        return f"{len(found)}," + "".join([(missing if t is None else t) + " " for _, _, t in found])
    return _of_distinct(inner, "string", line)


def morph_texts(inner: Column) -> Column:
    """Just the text of each ``<m>`` of a word (tags removed, entities decoded),
    without parsing the attributes."""
    plain = F.transform(F.regexp_extract_all(inner, F.lit(PLAIN_MORPH_RE), 2), _unescaped)
    return F.when(inner.rlike(PLAIN_INNER_RE), plain).otherwise(
        F.transform(_nested(inner, "m"), lambda e: unescape(strip_tags(e["body"]))))


def tei_words(pars: DataFrame, key: str = "doc_id") -> DataFrame:
    """All ``<w>`` elements of the paragraphs, at any depth, for counting words: no
    numbers, no text between them. Output (key, par_id, lang, lemma, xpostag, inner)."""
    d = pars.select(key, "par_id", "lang", "body", _plain_items(F.col("body")).alias("_items"))
    nested = F.transform(_nested(F.col("body"), "w"), lambda e: F.concat(e["tag"], e["body"], F.lit("</w>")))
    w = d.select(key, "par_id", "lang", F.explode(F.when(F.array_contains("_items", "<"), nested).otherwise(F.col("_items"))).alias("item"))
    item, tag = F.col("item"), F.col("_tag")
    w = w.filter(item.startswith("<")).select(key, "par_id", "lang", "item", F.substring_index(item, ">", 1).alias("_tag"))
    slash = F.when(tag.endswith("/"), 1).otherwise(0)
    w = w.select(key, "par_id", "lang", _from_byte(tag, 3, F.octet_length(tag) - 2 - slash).alias("attrs"),
                 _from_byte(item, F.octet_length(tag) + 2, F.octet_length(item) - F.octet_length(tag) - 5).alias("inner"))
    w = w.select("*", F.split("attrs", '"', -1).alias("_parts"))
    w = w.select(key, "par_id", "lang", _split_attr(F.col("_parts"), F.col("attrs"), "lemma").alias("_lemma"),
                 _split_attr(F.col("_parts"), F.col("attrs"), "pos").alias("xpostag"), "inner")
    return w.select(key, "par_id", "lang", _unescaped(F.col("_lemma")).alias("lemma"), "xpostag", "inner")


def tei_morphemes(toks: DataFrame, key: str = "doc_id") -> DataFrame:
    """S4 (rows): the ``<m>`` children of each word with text, base form and type.
    Output (key, par_id, tok_id, m_id, text, base_form, type)."""
    configure(toks.sparkSession)
    w = toks.filter(F.col("inner").isNotNull())
    w = w.select(key, "par_id", "tok_id", "lemma", "xpostag", _morph_structs(F.col("inner")).alias("_ms"))
    m = w.select(key, "par_id", "tok_id", "lemma", "xpostag", F.posexplode("_ms").alias("pos", "m"))
    return m.select(key, "par_id", "tok_id", "lemma", "xpostag",
                    (F.col("pos") + 1).cast("bigint").alias("m_id"),
                    F.col("m.text").alias("text"), F.col("m.base_form").alias("base_form"),
                    F.col("m.type").alias("type"))


def conllu_fields(toks: DataFrame, target_lang: str | Column | None = None, key: str = "doc_id",
                  orthography: Column | None = None) -> DataFrame:
    """S4 (token level) + P3: FORM of a word is its spelling normalised by the rule set
    that ``orthography`` names (T1; the raw form where the rewrite fails, for an unknown
    set and without ``orthography``); punctuation is never rewritten. FEATS = morpheme types minus null and ``root``
    (``_`` when none); MISC = ``origText=..,baseForms=a|b`` with ``None`` for a
    missing base form, plus ``,wordLang=..`` for a word of another language.
    Punctuation gets ``_`` for both."""
    configure(toks.sparkSession)
    # in one projection: one Python worker makes both
    fields = {"_mf": _morph_fields(F.col("inner"))}
    if orthography is not None:
        fields["_norm"] = normalise(F.when(F.col("inner").isNotNull(), F.col("form")), orthography)
    toks = toks.withColumns(fields)
    feats, bases = F.col("_mf.feats"), F.col("_mf.bases")
    tl = F.col("lang") if target_lang is None else (F.lit(target_lang) if isinstance(target_lang, str) else target_lang)
    foreign = F.col("word_lang").isNotNull() & (F.col("word_lang") != tl)
    # origText stays as written
    misc = F.concat(F.lit("origText="), F.col("form"), F.lit(",baseForms="), bases,
                    F.when(foreign, F.concat(F.lit(",wordLang="), F.col("word_lang"))).otherwise(F.lit("")))
    is_word = F.col("inner").isNotNull()
    form = F.col("form") if orthography is None else F.coalesce("_norm", "form")
    return toks.select(
        key, "par_id", "n", "tok_id", form.alias("form"), "lemma", "xpostag",
        F.when(is_word, feats).otherwise(F.lit("_")).alias("feats"), once(F.when(is_word, misc).otherwise(F.lit("_"))).alias("misc"))


def read_cell_xml(df: DataFrame, target_lang: str | Column, text_col: str = "text_name", xml_col: str = "xml",
                  order: Sequence[str] = ("row_pos",), chunk: Column | None = None) -> DataFrame:
    """Rows (Word, Text name, XML cell) -> the first ``<w>`` of each cell as a
    token. ``line_id`` is the running count per text, taken **before** words of
    another language are dropped, so ids keep their gaps (Q7).

    The running count is a distributed prefix sum (``operators.windows.running_number``):
    a text holding most rows is never gathered in one task."""
    from ..operators.windows import running_number
    configure(df.sparkSession)
    void = frozenset(VOID)
    cell = _of_distinct(F.col(xml_col), "struct<form:string,lemma:string,xpostag:string,lang:string,feats:string,bases:string>",
                        lambda v: M.cell_of(v, void))
    tl = F.lit(target_lang) if isinstance(target_lang, str) else target_lang
    df = df.select(text_col, *order, tl.alias("_tl"), cell.alias("_c"))
    base = df.select(
        text_col, *order, "_tl", F.col("_c.form").alias("form"), F.col("_c.lemma").alias("lemma"), F.col("_c.xpostag").alias("xpostag"),
        F.coalesce("_c.lang", "_tl").alias("word_lang"), F.coalesce("_c.feats", F.lit("_")).alias("feats"), F.col("_c.bases").alias("base_forms"))
    numbered = running_number(base, [text_col], list(order), "line_id", chunk=chunk)
    return numbered.filter(F.col("word_lang") == F.col("_tl")).drop("_tl")


def read_cell_csv(spark, path: str) -> DataFrame:
    """S6 file side: a CSV with a header ``Word, Text name, XML`` whose XML cells
    may span lines; ``row_pos`` keeps the file order (split start, then row)."""
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .csv(path).select("*", "_metadata.file_path", "_metadata.file_block_start"))
    df = df.withColumn("row_pos", F.monotonically_increasing_id())
    return df.select(F.col("Word").alias("word"), F.col("Text name").alias("text_name"),
                     F.col("XML").alias("xml"), "file_path", "file_block_start", "row_pos")
