"""Saved web pages (``page_id, url, html``) to fields and rows.

A rule is either a pattern, ``(pattern, group, kind)`` with ``kind='one'`` for the
first match (``regexp_extract``) and ``kind='all'`` for every match in page order
(``regexp_extract_all``), or an ``Element``: elements by tag, classes and
attribute contents, of which it takes the text or an attribute's value
(``element_text``, ``elements_text``, ``attribute``, ``attributes`` make them).

Elements are found by a pass over the page's markup for each tag that rules
name, in the tasks (``mapInArrow``, ``PAGES`` pages at a time). The tags of that
name, comments, scripts and styles cut the page into pieces; their depth is
counted, so an element ends with its own closing tag and not with that of an
inner element of the same name. Attributes may be quoted in either way or not at all; names of tags and
attributes are read in any case. The text of an element has no tags, comments,
scripts or styles, and its character references are decoded, once. Each page is
one row, so pages spread over all tasks, and nothing is shuffled."""

from __future__ import annotations

import html.entities
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from aerostar.session import importable

# Elements without content; what a browser reads &#128; to &#159; as.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
PAGES = 256  # decoded at once
C1 = {f"#{n}": bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}

_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_SKIP = rf"<!--.*?(?:-->|\Z)|<(?:script|style)(?u:\b){_INSIDE}>.*?(?:</(?:script|style)\s*>|\Z)"
_TAG = re.compile(rf"</?[A-Za-z]{_INSIDE}>")
_NAME, _SPACE = re.compile(r"^<[^\s/>]++", re.A), re.compile(r"\s+", re.A)
_ATTRIBUTE = re.compile(r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+""", re.A)
_PART = re.compile(r"([^\s=]++)(\s*+=?+\s*+)(.*+)", re.A | re.S)
_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);")


@dataclass(frozen=True)
class Element:
    """Elements ``tag`` with all the classes, among others and in any order, and
    with attributes that contain the given texts; ``take`` names the attribute
    whose value is wanted (None: the text). ``every``: all in page order, or the
    first, empty where there is none."""

    tag: str
    classes: tuple[str, ...] = ()
    holds: tuple[tuple[str, str], ...] = ()
    take: str | None = None
    every: bool = False


def element_text(tag: str, *classes: str, **holds: str) -> Element:
    """The text of the first such element (``aria_label=`` stands for
    ``aria-label``)."""
    return Element(tag, classes, _pairs(holds))


def elements_text(tag: str, *classes: str, **holds: str) -> Element:
    return Element(tag, classes, _pairs(holds), every=True)


def attribute(tag: str, name: str, *classes: str, **holds: str) -> Element:
    """The value of attribute ``name`` of the first such element that has it."""
    return Element(tag, classes, _pairs(holds), name)


def attributes(tag: str, name: str, *classes: str, **holds: str) -> Element:
    return Element(tag, classes, _pairs(holds), name, every=True)


def _pairs(holds: Mapping[str, str]) -> tuple[tuple[str, str], ...]:
    return tuple((k.replace("_", "-"), v) for k, v in holds.items())


def _values(attributes: str) -> dict[str, str]:
    """Values of an opening tag's attributes as they are written, by name in
    lower case; of several of a name the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        name, _, value = _PART.match(m[0]).groups()
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ('"', "'") else value)
    return out


def _fits(values: Mapping[str, str], rule: Element) -> bool:
    words = _SPACE.split(_decoded(values.get("class", ""))) if rule.classes else ()
    return (all(c in words for c in rule.classes)
            and all(text in _decoded(values.get(name.lower(), "")) for name, text in rule.holds))


def _found(page: str, tag: str, rules: Sequence[Element]) -> list[list[str]]:
    """The texts or attribute values of all elements of each rule for a tag, in
    page order."""
    opens = re.compile(rf"<{re.escape(tag)}(?=[\s/>])", re.A | re.I)
    taken: list[list[str]] = [[] for _ in rules]
    spans: list[list[tuple[int, int]]] = [[] for _ in rules]
    pieces, at, depth, n = [], 0, 0, 0
    inside: list[tuple[int, int, int]] = []  # depth, token and rule of what is open
    for m in re.finditer(rf"{_SKIP}|</?{re.escape(tag)}(?=[\s/>]){_INSIDE}>", page, re.A | re.I | re.S):
        token = m[0]
        pieces.append(page[at:m.start()])
        at = m.end()
        if opens.match(token):  # a script is a token, and one that skips
            depth += 1
            values = _values(_NAME.sub("", token, count=1))
            for k, rule in enumerate(rules):
                if _fits(values, rule):
                    if rule.take is None:
                        inside.append((depth, n, k))
                    elif rule.take.lower() in values:
                        taken[k].append(_decoded(values[rule.take.lower()]))
        elif token.startswith("</") and depth > 0:
            while inside and inside[-1][0] == depth:
                _, start, k = inside.pop()
                spans[k].append((start, n))
            depth -= 1
        n += 1
    pieces.append(page[at:])
    for _, start, k in inside:  # what is not closed ends with the page
        spans[k].append((start, n))
    return [taken[k] if rule.take is not None else
            [_decoded(_TAG.sub("", "".join(pieces[a + 1:b + 1]))) for a, b in sorted(spans[k])] for k, rule in enumerate(rules)]


def _character(m: re.Match) -> str:
    """What one reference stands for; a name that nobody knows stays as it is, a
    number that is no character is the replacement character."""
    name = m[0][1:-1]
    if name[0] != "#":
        return html.entities.html5.get(f"{name};", m[0])
    number = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    if f"#{number}" in C1:
        return C1[f"#{number}"]
    return "\ufffd" if number == 0 or 0xD800 <= number <= 0xDFFF or number > 0x10FFFF else chr(number)


def _decoded(text: str) -> str:
    return _REFERENCE.sub(_character, text) if "&" in text else text


def _text(column: pa.Array) -> list[str | None]:
    """The column's texts; bytes that are no UTF-8 become replacement characters."""
    return [None if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def decode_entities(c: Column) -> Column:
    """Character references that end in a semicolon (named, decimal or
    hexadecimal) to the characters they stand for; each is read once, so
    ``&amp;lt;`` gives ``&lt;``."""
    @F.arrow_udf("string")
    def decoded(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else _decoded(x) for x in _text(texts)], pa.string())
    spark = SparkSession.getActiveSession()
    if spark is not None:
        importable(spark)
    return decoded(c)


def _elements(df: DataFrame, rules: Mapping[str, Element], page: str) -> DataFrame:
    """df with a column for each rule in the place of the page's."""
    for rule in rules.values():
        if rule.take is None and rule.tag.lower() in VOID:
            raise ValueError(f"<{rule.tag}> has no text")
    importable(df.sparkSession)
    by_tag: dict[str, list[str]] = {}
    for name, rule in rules.items():
        by_tag.setdefault(rule.tag.lower(), []).append(name)
    kinds = {name: pa.list_(pa.string()) if rule.every else pa.string() for name, rule in rules.items()}
    others = [c for c in df.columns if c != page]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, PAGES):
                batch = whole.slice(start, PAGES)
                out: dict[str, list] = {name: [] for name in rules}
                for text in _text(batch[page]):
                    for tag, names in by_tag.items():
                        found = _found(text, tag, [rules[n] for n in names]) if text is not None else [None] * len(names)
                        for name, values in zip(names, found):
                            out[name].append(values if rules[name].every else values[0] if values else "")
                yield pa.record_batch([*(batch[c] for c in others), *(pa.array(out[n], kinds[n]) for n in rules)], names=[*others, *rules])

    schema = StructType([df.schema[c] for c in others] + [
        StructField(n, ArrayType(StringType()) if r.every else StringType()) for n, r in rules.items()])
    return df.mapInArrow(read, schema)


def extract_page_fields(df: DataFrame, rules: Mapping[str, Element | tuple[str, int, str]],
                        html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    cols = []
    elements = {}
    for name, rule in rules.items():
        if isinstance(rule, Element):
            elements[name] = rule
            continue
        pattern, group, kind = rule
        if kind not in ("one", "all"):
            raise ValueError(f"rule kind must be 'one' or 'all', not {kind!r}")
        if kind == "one":
            cols.append(F.regexp_extract(F.col(html), pattern, group).alias(name))
        else:
            cols.append(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(group)).alias(name))
    if not elements:
        return df.select(*keep, *cols)
    return _elements(df.select(*keep, *cols, F.col(html).alias("__page")), elements, "__page").select(*keep, *rules)


def unequal_lists(lists: list[str], pad: Mapping[str, str] | None = None) -> Column:
    """Is a list longer than the first, or (unless padded) shorter?"""
    out = F.lit(False)
    for c in lists[1:]:
        out = out | (F.size(c) > F.size(lists[0]) if c in (pad or {}) else F.size(c) != F.size(lists[0]))
    return out


def zip_fields(df: DataFrame, lists: list[str], keep: tuple[str, ...] = (),
               pad: Mapping[str, str] | None = None, check: bool = True,
               pos: str = "pos") -> DataFrame:
    """Positionally aligned lists -> one row per position, with ``pos`` (0-based).

    Lists named in ``pad`` may be shorter; they are padded at the end with the
    given value. Every other list must have the length of the first one, and
    none may be longer, else the job fails (as building a table from unequal
    lists does), unless ``check=False``. ``unequal_lists`` tells such pages
    apart beforehand, to divert them."""
    pad = dict(pad or {})
    frame = df
    if check:
        # A filter, not a projected column: an unused column would be pruned
        # by the optimizer and the check would never run.
        frame = frame.filter(F.assert_true(~unequal_lists(lists, pad), F.lit("page lists differ in length")).isNull())
    zipped = F.arrays_zip(*[F.col(c) for c in lists])
    rows = frame.select(*keep, F.posexplode(zipped).alias(pos, "__z"))
    # arrays_zip pads the shorter lists with null at the end.
    values = [F.coalesce(F.col("__z")[c], F.lit(pad[c])).alias(c) if c in pad
              else F.col("__z")[c].alias(c) for c in lists]
    return rows.select(*keep, pos, *values)
