"""Elements of pages against a parser written for this test, and character
references against the standard library's."""

import html
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from aerostar.sources import attribute, attributes, decode_entities, element_text, elements_text, extract_page_fields


class Texts(HTMLParser):
    """Texts of the elements of a tag that a test accepts, ended at their own depth."""

    def __init__(self, tag, accepts):
        super().__init__(convert_charrefs=True)
        self.tag, self.accepts, self.depth, self.open, self.done, self.n = tag, accepts, 0, [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.depth += 1
            if self.accepts(dict(reversed(attrs))):
                self.open.append([self.depth, self.n, ""])
                self.n += 1

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.done += [x[1:] for x in self.open if x[0] == self.depth]
            self.open = [x for x in self.open if x[0] < self.depth]
            self.depth -= 1

    def handle_data(self, data):
        if self.cdata_elem is None:
            for x in self.open:
                x[2] += data

    def result(self, page):
        self.feed(page)
        self.close()
        return [t for _, t in sorted(self.done + [x[1:] for x in self.open])]


def random_page(rng):
    def attrs():
        out = []
        for _ in range(rng.randint(0, 3)):
            name = rng.choice(["class", "CLASS", "data-x", "title", "aria-label"])
            value = rng.choice(["al", "al big", "x al y", "al2", "a > b", "US dollars 5", "&lt;al&gt;", ""])
            out.append(rng.choice([f'{name}="{value}"', f"{name}='{value}'", f"{name} = '{value}'"] + ([f"{name}={value}"] if value.isalnum() else [])))
        return "".join(rng.choice([" ", "\n", "  "]) + a for a in out)

    def body(depth):
        out = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.randint(0, 9)
            if kind < 4 and depth < 4:
                tag = rng.choice(["div", "DIV", "span", "b", "divider"])
                end = "" if rng.random() < 0.08 else f"</{tag}>" if rng.random() < 0.9 else f"</{tag} >"
                out.append(f"<{tag}{attrs()}>{body(depth + 1)}{end}")
            elif kind == 4:
                out.append("<!-- <div class='al'> </div> -->")
            elif kind == 5:
                out.append("<script>var t = '</div><div class=al>';</script>")
            elif kind == 6:
                out.append("</div>")
            elif kind == 7:
                out.append("<br><br/>")
            else:
                out.append(rng.choice(["text ", "1 &lt; 2 ", "&amp;lt; ", "caf&eacute;\n", "&#x1F600; ", "&#39;"]))
        return "".join(out)
    return body(0)


def test_elements_against_a_parser(spark):
    rng = random.Random(11)
    pages = [(k, random_page(rng)) for k in range(1500)]
    has = lambda c: lambda a: c in (a.get("class") or "").split()
    rules = {"every": (elements_text("div", "al"), "div", has("al")),
             "any": (elements_text("span"), "span", lambda a: True),
             "holds": (elements_text("div", aria_label="US dollars"), "div", lambda a: "US dollars" in (a.get("aria-label") or ""))}
    df = spark.createDataFrame(pages, "page_id long, html string")
    got = extract_page_fields(df, {k: r for k, (r, _, _) in rules.items()} | {"first": element_text("div", "al")}).collect()
    nested = 0
    for row, (_, page) in zip(sorted(got), pages):
        for name, (_, tag, accepts) in rules.items():
            want = Texts(tag, accepts).result(page)
            assert row[name] == want, (page, name)
            nested += len(want) > 1
        assert row.first == (row.every[0] if row.every else "")
    assert nested > 100


def test_attributes_in_all_quote_styles(spark):
    page = ("""<a href="/1" class=x>1</a><A class='x y' HREF='/2?a=1&amp;b=2'>2</A><a class="x" href=/3>3</a><a class=xx href="/4">4</a>"""
            """<a data-href="/no" title='class="x" href="/no"'>5</a><a class="x">6</a><a class="x" href>7</a><a href=/8 href="/9" class=x>""")
    df = spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id long, html string")
    rows = extract_page_fields(df, {"all": attributes("a", "href", "x"), "one": attribute("a", "HREF", "x"), "none": attribute("i", "href")}).orderBy("page_id").collect()
    assert rows[0]["all"] == ["/1", "/2?a=1&b=2", "/3", "", "/8"] and rows[0].one == "/1" and rows[0].none == ""
    assert rows[1]["all"] == [] and rows[1].one == "" and not rows[2]["all"] and rows[2].one == ""


def test_long_tags_comments_and_deep_nesting(spark):
    deep = "<div class=al>" * 300 + "x" + "</div>" * 300
    page = f"<div style='{'a' * 200_000}' {' '.join(f'd{k}=v' for k in range(20_000))} class=al>A</div><!--{'-' * 100_000}--><div class=al>B<div>C</div>{deep}"
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    found = extract_page_fields(df, {"t": elements_text("div", "al")}).first().t
    assert found == ["A", "BC" + "x"] + ["x"] * 300


def test_references_as_the_standard_library(spark):
    rng = random.Random(5)
    names = [k for k in html.entities.html5 if k.endswith(";")]
    texts = [f"{rng.choice(['', 'a', '&', '&amp;'])}&{n}{rng.choice(['', 'b', ' ', ';'])}" for n in names]
    texts += [f"x&#{n};y" for n in [*range(128, 160), 0, 9, 10, 39, 955, 8212, 55296, 65533, 128512, 1114109, 1114112]] + [f"&#x{n:x};" for n in (39, 8212, 128512)]
    texts += ["&#38;lt;", "&amp;amp;lt;", "plain", "", "&unknown;", "a & b; c", "&#x27;&#X27;"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: r.d for r in df.select("k", decode_entities(F.col("t")).alias("d")).collect()}
    differ = [(t, got[k], html.unescape(t)) for k, t in enumerate(texts) if got[k] != html.unescape(t)]
    assert not differ, differ[:5]
    assert spark.createDataFrame([(None,)], "t string").select(decode_entities(F.col("t"))).first()[0] is None


def test_all_rules_read_a_page_in_one_pass(spark):
    """One operator finds the elements of all rules, also where a filter and an
    explode above it read them, and no table of names is parsed for a reference."""
    page = "<div class=a title='&amp;'>" + "<div>&lt;&#65;</div>" * 50 + "</div><span class=b>&dollar;</span>"
    df = spark.createDataFrame([(k, page) for k in range(3)] + [(3, None)], "page_id long, html string")
    rules = {"t": elements_text("div"), "s": element_text("span", "b"), "at": attributes("div", "title", "a"), "lang": ("<(span)", 1, "one")}
    found = extract_page_fields(df, rules)
    assert found.columns == ["page_id", *rules]
    read = found.where(F.size("t") >= 0).select("page_id", F.explode("t").alias("t"), "s", "at", "lang")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "from_json" not in plan
    rows = read.collect()
    assert len(rows) == 153 and {(r.s, tuple(r["at"]), r.lang) for r in rows} == {("$", ("&",), "span")}
    assert found.where("page_id = 3").first()[1:] == (None, "", None, None)
