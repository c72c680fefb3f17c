"""Listing fields from stored web pages, by column expressions only.

A rule is a short path: its first step may be anywhere in the page, each further one is a child of the one before.
A page is cut once into tokens (texts, tags, comments, whole scripts). One fold over its tags keeps the open elements,
innermost first, each with a number whose bits say which steps of which rules it fulfils: an element fulfils a step if it
fits it and its parent fulfils the step before. Closed elements that fulfil a last step are found, as ranges of tokens.

Comments, scripts and styles are no elements; tags and attributes are found in any case and with either quote; named entities
of HTML 4 and numeric ones are decoded. An element that is not closed runs to the end of what it is in. Null is an empty page.
Elements of one name that fulfil nothing and lie directly in each other are one counted entry. The fold takes time in
proportion to the tags times the open entries. Decoding calls a method of the Java library that Spark brings,
which the optimizer takes for nondeterministic: filter the pages before extraction, not after it.

A tidy page needs no fold: in it every element is closed in order, as one pattern tells, so that patterns for whole elements find
what the fold would find. Pages that are not tidy, nested deeper than the patterns, or that have elements of a first step
in each other, are folded.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelframe import fixed

Mark = tuple[str, str] | str
Step = tuple[str, Mark]

_VOID = "area base br col embed hr img input link meta source track wbr".split()
_HIDDEN = ("script", "style")
# A new one of these ends an open one beside it.
_SIBLINGS = ("li", "p", "option", "tr", "td", "th")
_LISTS = ("ul", "ol", "select", "table", "div")

# Possessive throughout, so that no text makes the matcher go back or recurse.
_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+"""
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<({'|'.join(_HIDDEN)})\b{_ATTRIBUTES}>.*?(?:</\1\s*+>|\z)"
    r"|<[!?][^>]*+(?:>|\z)"
    rf"|</?[a-z]{_ATTRIBUTES}>"
    r"|[^<]++|<"
)
_TAG_NAME = r"^</?([a-zA-Z][^\s/>]*+)"
_BLANKS = " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85                　"
_CUT = "﷐﷑﷐"

# Levels of open elements that the patterns for tidy pages follow.
_LEVELS = 32
# What follows "<" where it begins no element; a look at the next letter spares most of the trials.
_UNSEEN = r"!--.*?(?:-->|\z)|[!?][^>]*+(?:>|\z)|(?=s)(?:" + "|".join(
    rf"{name}\b{_ATTRIBUTES}>.*?(?:</{name}\s*+>|\z)" for name in _HIDDEN
) + ")"
_VOID_NAME = rf"(?=[{''.join(sorted({name[0] for name in _VOID}))}])(?:{'|'.join(_VOID)})(?=[\s/>])"
_NAME = r"[a-z][a-z0-9:_-]*+(?=[\s/>])"


def _tidy() -> str:
    """A page in which each element is closed in order, by its own tag; the tags' values hold no angle brackets."""
    plain = r"""(?:[^<>"'=]++|=\s*+(?:"[^"<>]*+"|'[^'<>]*+')?+)*+>"""
    inside = f"(?:[^<]++|<(?:{_UNSEEN}|{_VOID_NAME}{plain}))*+"
    for k in range(_LEVELS):
        element = rf"(?<n{k}>{_NAME}){plain}(?:(?<=/>)|{inside}</\k<n{k}>\s*+>)"
        inside = f"(?:[^<]++|<(?!/)(?:{_UNSEEN}|{_VOID_NAME}{plain}|{element}))*+"
    return rf"(?is)\A{inside}\z"


def _rest(group: int) -> str:
    """What follows the first tag of an element of a tidy page, up to its end; the group has the element's name."""
    same, other = rf"\{group}(?=[\s/>])[^>]*+>", rf"{_UNSEEN}|(?!/?\{group}[\s/>])[^>]*+>"
    rest = f"(?:[^<]++|<(?:{other}))*+"
    for _ in range(_LEVELS):
        rest = rf"(?:[^<]++|<(?:{other}|{same}(?:(?<=/>)|{rest}</\{group}\s*+>)))*+"
    return rf"(?:(?<=/>)|{rest}</\{group}\s*+>)"


_TIDY = _tidy()
# An element that would end one of its name around it.
_BESIDE = rf"(?is)<({'|'.join(_SIBLINGS)})(?=[\s/>])[^>]*+(?<!/)>(?:[^<]++|<(?:{_UNSEEN}|(?!/?\1[\s/>])))*+<\1[\s/>]"
_CHILD = rf"(?is)\G(?:\A<[^>]*+>)?+(?:[^<]++|<(?:{_UNSEEN}))*+(<(?:{_VOID_NAME}[^>]*+>|({_NAME})[^>]*+>{_rest(2)}))"
_NO_TEXT = rf"(?is)<(?:{_UNSEEN}|(?!br[\s/>])[^>]*+>)"
_FIRST_ANCHOR = rf"(?is)\A<[^>]*+>(?:[^<]++|<(?:{_UNSEEN}|(?!a[\s/>])[^>]*+>))*+(<a(?=[\s/>])[^>]*+>)"
# Bits of a long that one fold can use.
_STEPS_AT_ONCE = 60


def has_class(fragment: str) -> Mark:
    """Mark: the class attribute contains ``fragment``."""
    return ("class", fragment)


def has_style(style: str) -> Mark:
    return ("style", style)


@dataclass(frozen=True)
class PathText:
    """Visible text of the n-th element at a path, empty when there is none."""

    path: tuple[Step, ...]
    nth: int = 1


FieldRule = PathText | Callable[[Column], Column]


def element_text(tag: str, mark: Mark = "", nth: int = 1) -> PathText:
    return PathText(((tag, mark),), nth)


def path_text(*path: Step, nth: int = 1) -> PathText:
    return PathText(path, nth)


def pattern_text(pattern: str) -> FieldRule:
    """Rule: first group of the first match of a pattern, empty when there is none."""
    return lambda html: F.coalesce(F.regexp_extract(html, pattern, 1), F.lit(""))


def listing_rules() -> dict[str, FieldRule]:
    rules: dict[str, FieldRule] = {}
    for name, (tag, mark, nth) in fixed.LISTING_PAGE_FIELDS.items():
        inside = [("div", has_class(fixed.LISTING_PAGE_PARENTS[name]))] if name in fixed.LISTING_PAGE_PARENTS else []
        rules[name] = path_text(*inside, (tag, has_class(mark)), nth=nth)
    rules["location"] = element_text("div", has_style(fixed.LISTING_LOCATION_STYLE))
    value = ("span", has_class(fixed.OPTION_VALUE_CLASS))
    rules |= {name: path_text(("div", has_class(mark)), value) for name, mark in fixed.LISTING_OPTION_CLASSES.items()}
    return rules


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once also inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _has(mask: Column, bits: int) -> Column:
    return mask.bitwiseAND(_long(bits)) != 0


def _quoted(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name as it stands in the page, empty when there is none."""
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
    before = rf"(?:[\s/]++(?!{name}[\s=/>])[^\s=/>]++(?:\s*+=\s*+{value}?+)?+)*+"
    return F.regexp_extract(tag, rf"(?i)^<[^\s/>]++{before}[\s/]++{name}\s*+=\s*+({value})", 1)


def _attribute(tag: Column, name: str) -> Column:
    """The same without quotes; entities stay."""
    return F.regexp_replace(_quoted(tag, name), r"""(?s)^(["'])(.*)\1$""", "$2")


def _decoded(texts: Column) -> Column:
    """The texts of an array with their entities decoded, by one call for all of them."""
    method = F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4")
    return F.when(F.size(texts) == 0, texts).otherwise(F.split(F.java_method(*method, F.array_join(texts, _CUT)), _CUT))


class _Steps:
    """Bits for the steps of several paths; a path's steps have neighbouring bits."""

    def __init__(self, paths: Sequence[Sequence[Step]]):
        self.first, self.last, self.fits, at = 0, [], {}, 0
        for path in paths:
            self.first |= 1 << at
            for step in path:
                self.fits[step] = self.fits.get(step, 0) | 1 << at
                at += 1
            self.last.append(1 << at - 1)
        if at > _STEPS_AT_ONCE:
            raise ValueError(f"more than {_STEPS_AT_ONCE} steps in one scan")

    def own(self, tag: Column, name: Column) -> Column:
        """Bits of the steps that a tag fits, whatever its parent."""
        choice = F.when(F.startswith(tag, F.lit("</")), _long(0))
        for element in dict.fromkeys(element for element, _ in self.fits):
            bits = _long(self.fits.get((element, ""), 0))
            for (of, mark), fulfilled in self.fits.items():
                if of == element and mark:
                    # The pattern runs only where the tag has the fragment at all.
                    fits = F.contains(tag, F.lit(mark[1])) & F.contains(_quoted(tag, mark[0]), F.lit(mark[1]))
                    bits = bits.bitwiseOR(F.when(fits, _long(fulfilled)).otherwise(_long(0)))
            choice = choice.when(name == element, bits)
        return choice.otherwise(_long(0))

    def tags(self, tokens: Column) -> Column:
        def tag(token, i):
            return _with(
                F.when(F.startswith(token, F.lit("<")), F.lower(F.regexp_extract(token, _TAG_NAME, 1))).otherwise(""),
                lambda name: F.struct(
                    name.alias("name"),
                    (i + 1).alias("at"),
                    F.startswith(token, F.lit("</")).alias("closing"),
                    (F.endswith(token, F.lit("/>")) | name.isin(_VOID)).alias("empty"),
                    self.own(token, name).alias("own"),
                ),
            )

        return F.filter(F.transform(tokens, tag), lambda t: (t["name"] != "") & ~t["name"].isin(*_HIDDEN))

    def found(self, tags: Column, end: Column) -> Column:
        """Elements that fulfil a last step, in page order: their own token, the first token after them, their bits."""
        wanted = sum(self.last)
        empty = F.struct(
            F.array().cast("array<struct<name:string,at:int,mask:bigint,many:int>>").alias("stack"),
            F.array().cast("array<struct<at:int,until:int,mask:bigint>>").alias("found"),
        )

        def entry(name, at, mask, many):
            return F.struct(name.alias("name"), at.alias("at"), mask.alias("mask"), many.alias("many"))

        def closed(open_, count, until):
            fulfilled = F.filter(F.slice(open_["stack"], F.lit(1), count), lambda e: _has(e["mask"], wanted))
            ranges = F.transform(fulfilled, lambda e: F.struct(e["at"].alias("at"), until.alias("until"), e["mask"].alias("mask")))
            return F.when(count > 0, F.concat(open_["found"], ranges)).otherwise(open_["found"])

        def step(open_, t):
            def beside(place):
                return F.when(F.get(open_["stack"], place - 1)["name"] == t["name"], place).otherwise(F.lit(0))

            sibling = F.array_position(F.transform(open_["stack"]["name"], lambda n: (n == t["name"]) | n.isin(*_LISTS)), True)
            leaves = (
                F.when(t["closing"], F.array_position(open_["stack"]["name"], t["name"]))
                .when(t["name"].isin(*_SIBLINGS) & ~t["empty"], _with(sibling.cast("int"), beside))
                .otherwise(F.lit(0))
                .cast("int")
            )

            def moved(count):
                stack = open_["stack"]
                left = F.get(stack, count - 1)
                fewer = F.array(entry(left["name"], left["at"], left["mask"], left["many"] - 1))
                after = F.when(count > 0, F.slice(stack, count + 1, F.size(stack))).otherwise(stack)
                rest = F.when(left["many"] > 1, F.concat(fewer, after)).otherwise(after)
                return _with(rest, lambda rest: grown(rest, count))

            def grown(rest, count):
                top = F.get(rest, F.lit(0))
                mask = t["own"].bitwiseAND(F.shiftleft(F.coalesce(top["mask"], _long(0)), 1).bitwiseOR(_long(self.first)))
                alike = (top["name"] == t["name"]) & (top["mask"] == 0) & (mask == 0)
                more = F.concat(F.array(entry(top["name"], top["at"], top["mask"], top["many"] + 1)), F.slice(rest, 2, F.size(rest)))
                made = F.concat(F.array(entry(t["name"], t["at"], mask, F.lit(1))), rest)
                alone = F.array(F.struct(t["at"].alias("at"), (t["at"] + 1).alias("until"), mask.alias("mask")))
                ended = closed(open_, count, t["at"])
                return F.struct(
                    F.when(t["closing"] | t["empty"], rest).when(alike, more).otherwise(made).alias("stack"),
                    F.when(t["empty"] & _has(mask, wanted), F.concat(ended, alone)).otherwise(ended).alias("found"),
                )

            return F.when(t["empty"] & (t["own"] == 0), open_).otherwise(_with(leaves, moved))

        return F.aggregate(tags, empty, step, lambda s: F.sort_array(closed(s, F.size(s["stack"]), end)))

    def of(self, found: Column, path: int) -> Column:
        return F.filter(found, lambda e: _has(e["mask"], self.last[path]))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or not c.isascii() else f"\\{c}" for c in text)


class _Whole:
    """Whole elements of tidy pages, as texts from their first tag to their last; ``steps`` are the first ones of the paths."""

    def __init__(self, steps: Sequence[Step]):
        marks: dict[str, set[str]] = {}
        for element, mark in steps:
            marks.setdefault(element, set()).add(mark[1] if mark else "")
        self.starts = "|".join(rf"{_literal(element)}(?=[\s/>]){self._holding(of)}" for element, of in marks.items())
        void = [_literal(element) for element in marks if element in _VOID]
        other = [_literal(element) for element in marks if element not in _VOID]
        whole = [rf"<(?:{'|'.join(void)})(?=[\s/>])[^>]*+>"] if void else []
        whole += [rf"<({'|'.join(other)})(?=[\s/>])[^>]*+>{_rest(2)}"] if other else []
        self.pattern = rf"(?:[^<]++|<(?:{_UNSEEN}|(?!{self.starts})[^>]*+>))++|({'|'.join(whole)})"

    @staticmethod
    def _holding(marks: set[str]) -> str:
        """The rest of a tag that has one of the marks somewhere."""
        if "" in marks:
            return ""
        begin = "".join(sorted({_literal(mark[0]) for mark in marks}))
        one = "|".join(map(_literal, sorted(marks)))
        return rf"(?-i:(?:[^>{begin}]++|(?!{one})[{begin}])*+(?:{one}))"

    def of(self, page: Column, inside: bool = False) -> Column:
        """Elements that may fulfil one of the steps, in page order; those ``inside`` an element are without itself."""
        begin = r"\A<[^>]*+>|" if inside else ""
        return F.filter(F.regexp_extract_all(page, F.lit(f"(?is){begin}{self.pattern}"), F.lit(1)), lambda e: e != "")

    def nested(self, elements: Column) -> Column:
        """Whether one of them may have another one inside."""
        return F.exists(elements, lambda e: e.rlike(rf"(?is)\A<[^>]*+>(?:[^<]++|<(?!{self.starts}))*+<(?:{self.starts})"))


def _fits(element: Column, step: Step) -> Column:
    name, mark = step
    if name != name.lower():
        return F.lit(False)
    fits = element.rlike(rf"(?i)\A<{_literal(name)}[\s/>]")
    return F.contains(element, F.lit(mark[1])) & fits & F.contains(_quoted(element, mark[0]), F.lit(mark[1])) if mark else fits


def _fitting(elements: Column, step: Step) -> Column:
    return F.filter(elements, lambda e: _fits(e, step))


def _at_path(elements: Column, path: Sequence[Step]) -> Column:
    """The whole elements at a path, whose first steps are among the given ones."""
    found = _fitting(elements, path[0])
    for step in path[1:]:
        inside = F.transform(found, lambda e: F.regexp_extract_all(e, F.lit(_CHILD), F.lit(1)))
        found = _fitting(F.flatten(inside), step)
    return found


def _whole_text(element: Column) -> Column:
    """Visible text of a whole element with outer blanks trimmed."""
    raw = F.regexp_replace(F.regexp_replace(element, _NO_TEXT, _CUT), r"<[^>]*+>", "\n")
    method = F.lit("org.apache.commons.text.StringEscapeUtils"), F.lit("unescapeHtml4")
    raw = F.when(F.contains(element, F.lit("&")), F.java_method(*method, raw)).otherwise(raw)
    return F.btrim(F.replace(F.replace(raw, F.lit(_CUT), F.lit("")), F.lit("\xa0"), F.lit(" ")), F.lit(_BLANKS))


def _first_text(elements: Column, nth: int = 1) -> Column:
    return F.coalesce(_with(F.get(elements, F.lit(nth - 1)), _whole_text), F.lit(""))


def _scan(
    df: DataFrame, html: str, keep, paths: Sequence[Sequence[Step]], inner: Sequence[Sequence[Step]] = ()
) -> tuple[DataFrame, list[Column], list[Column]]:
    """Per page: ``kept`` columns, ``html``, its ``tokens`` and ``shown`` texts; and per path a column of what was found.

    ``whole`` has the elements of the paths' first steps where the page is tidy, and is null where it is not; then, and only then,
    the page has tokens. The last columns are the whole elements at each path. Paths of ``inner`` are looked for
    within those; they have one step.
    """
    kept = F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))
    scanned = df.select(kept.alias("kept"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    first = _Whole([path[0] for path in paths])
    page = F.col("html")
    tidy = page.rlike(_TIDY) & ~page.rlike(_BESIDE) & ~F.contains(page, F.lit(_CUT))
    scanned = scanned.withColumn("whole", F.when(tidy, first.of(page)))
    again = first.nested(F.col("whole"))
    if inner:
        below = _Whole([path[0] for path in inner])
        again = again | F.exists("whole", lambda e: below.nested(below.of(e, inside=True)))
    scanned = scanned.withColumn("whole", F.when(~again, F.col("whole")))
    wholes = [_at_path(F.col("whole"), path) for path in paths]
    paths = [*paths, *inner]
    scanned = scanned.withColumn("tokens", F.when(F.col("whole").isNull(), F.regexp_extract_all("html", F.lit(_TOKEN), F.lit(0))))
    columns: list[Column] = []
    start, part = 0, 0
    while start < len(paths):
        stop, steps = start, 0
        while stop < len(paths) and (stop == start or steps + len(paths[stop]) <= _STEPS_AT_ONCE):
            steps += len(paths[stop])
            stop += 1
        bits = _Steps(paths[start:stop])
        name = f"found{part}"
        end = F.size("tokens") + 1
        scanned = scanned.withColumn(name, bits.found(bits.tags(F.col("tokens")), end))
        columns += [bits.of(F.col(name), i) for i in range(stop - start)]
        start, part = stop, part + 1

    def shown(token):
        is_break = F.lower(F.regexp_extract(token, _TAG_NAME, 1)) == "br"
        return F.when(is_break, "\n").when(F.startswith(token, F.lit("<")) & (token != "<"), "").otherwise(token)

    return scanned.withColumn("shown", _decoded(F.transform("tokens", shown))), columns, wholes


def _either(whole: Column, folded: Column) -> Column:
    return F.when(F.col("whole").isNotNull(), whole).otherwise(folded)


def _text(element: Column) -> Column:
    """Visible text with outer blanks trimmed."""
    parts = F.array_join(F.slice(F.col("shown"), element["at"], element["until"] - element["at"]), "")
    return F.btrim(F.replace(parts, F.lit("\xa0"), F.lit(" ")), F.lit(_BLANKS))


def _nth_text(found: Column, nth: int = 1) -> Column:
    return F.coalesce(_with(F.get(found, F.lit(nth - 1)), _text), F.lit(""))


def _beside_kept(scanned: DataFrame, keep, columns: Sequence[Column]) -> DataFrame:
    """Kept and new columns; the new ones are named in a struct first, so that no kept name can be taken for a step's."""
    made = scanned.select("kept", F.struct(*columns).alias("made"))
    return made.select(*(["kept.*"] if keep else []), "made.*")


def extract_fields(df: DataFrame, html: str = "html", rules: dict[str, FieldRule] | None = None, keep=()) -> DataFrame:
    """One text column per rule; a missing field is the empty text."""
    rules = rules or listing_rules()
    paths = {name: rule for name, rule in rules.items() if isinstance(rule, PathText)}
    scanned, found, whole = _scan(df, html, keep, [rule.path for rule in paths.values()])
    at = {
        name: _either(_first_text(elements, rule.nth), _nth_text(column, rule.nth))
        for (name, rule), column, elements in zip(paths.items(), found, whole, strict=True)
    }
    columns = [(at[name] if name in at else rule(F.col("html"))).alias(name) for name, rule in rules.items()]
    return _beside_kept(scanned, keep, columns)


def extract_links(df: DataFrame, html: str = "html", path: Sequence[Step] | None = None, keep=()) -> DataFrame:
    """One row per list item with its position and its first link, empty when it has none."""
    items = tuple(path or (("div", has_class(fixed.INDEX_LIST_CLASS)), ("div", has_class(fixed.INDEX_ITEM_CLASS))))
    scanned, (found,), (whole,) = _scan(df, html, keep, [items])

    def first_link(item):
        inside = F.slice(F.col("tokens"), item["at"] + 1, item["until"] - item["at"] - 1)
        return F.coalesce(_attribute(F.get(F.filter(inside, lambda t: t.rlike(r"(?i)^<a[\s/>]")), F.lit(0)), "href"), F.lit(""))

    def first_anchor(item):
        return _attribute(F.regexp_extract(item, _FIRST_ANCHOR, 1), "href")

    found = _either(F.transform(whole, first_anchor), F.transform(found, first_link))
    links = scanned.select("kept", _decoded(found).alias("links"))
    return links.select(*(["kept.*"] if keep else []), F.posexplode("links").alias("position", "link"))


def extract_details(df: DataFrame, html: str = "html", keep=()) -> DataFrame:
    """Description, date and contact as text; features and image links as arrays."""
    fields = [(("div", has_class(mark)),) for mark in fixed.DETAIL_PAGE_FIELDS.values()]
    listed = (("div", has_class(fixed.FEATURES_CLASS)), ("ul", ""), ("li", ""))
    shown = (("div", has_class(fixed.CAROUSEL_CLASS)), ("div", has_class("item")), ("img", ""))
    scanned, found, whole = _scan(df, html, keep, [*fields, listed, shown])
    *texts, features, images = found
    *whole_texts, whole_features, whole_images = whole
    sources = F.transform(images, lambda e: _attribute(F.get(F.col("tokens"), e["at"] - 1), "src"))
    sources = _either(F.transform(whole_images, lambda e: _attribute(e, "src")), sources)
    columns = [
        _either(_first_text(elements), _nth_text(column)).alias(name)
        for name, column, elements in zip(fixed.DETAIL_PAGE_FIELDS, texts, whole_texts, strict=True)
    ]
    columns.append(_either(F.transform(whole_features, _whole_text), F.transform(features, _text)).alias("features"))
    columns.append(_decoded(F.filter(sources, lambda s: s != "")).alias("image_urls"))
    return _beside_kept(scanned, keep, columns)


def extract_amenities(df: DataFrame, html: str = "html", marks: dict[str, str] | None = None, keep=()) -> DataFrame:
    """Map of amenity kind to its nearby places; kinds without a mark stay empty."""
    marks = {"schools": "nearby-schools"} if marks is None else marks
    paths = [(("div", has_class(mark)), ("div", has_class("item"))) for mark in marks.values()]
    inner = [(("div", has_class("name")),), (("div", has_class("distance")),)]
    scanned, found, whole = _scan(df, html, keep, paths, inner)
    *items, names, distances = found
    below = _Whole([path[0] for path in inner])

    def first_inside(item, parts):
        return _nth_text(F.filter(parts, lambda e: (e["at"] > item["at"]) & (e["at"] < item["until"])))

    def places(column):
        return F.transform(
            column, lambda item: F.struct(first_inside(item, names).alias("name"), first_inside(item, distances).alias("distance"))
        )

    def whole_places(elements):
        def place(parts):
            texts = (_first_text(_fitting(parts, path[0])) for path in inner)
            return F.struct(*(text.alias(name) for name, text in zip(("name", "distance"), texts, strict=True)))

        return F.transform(F.transform(elements, lambda item: below.of(item, inside=True)), place)

    kind = "array<struct<name:string,distance:string>>"
    at = {name: _either(whole_places(elements), places(column)) for name, column, elements in zip(marks, items, whole, strict=True)}
    kinds = dict.fromkeys([*fixed.AMENITY_KINDS, *marks])
    held = [x for name in kinds for x in (F.lit(name), (at[name] if name in at else F.array()).cast(kind))]
    return _beside_kept(scanned, keep, [F.create_map(*held).alias("nearby_amenities")])
