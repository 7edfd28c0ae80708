"""Main text of web pages by deduction of a site's template from equivalence classes.

Tokens are the elements of a page, told apart by the path of elements they stand in. Tokens
of one host with the same occurrence vector (how often each stands in every page) form a
class. A class is frequent if enough pages have it, and valid if its tokens stand once in each of those
pages, in one order, and nest: what is above a member belongs to a valid class too. Valid
classes, one within a slot of the other, are the host's template; the classes that a page has are its
layout. Every slot of the layout with varying text, menus and the like set aside, is read.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices
from txclean.shared import shared_table

# Elements by what they do in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
RAW = set("script style noscript template textarea title iframe svg math object select button".split())
BLOCKS_END_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
LEAVES = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tr td th figure figcaption".split())
# What never is main text, by element, and by words of class, id and role.
ASIDE_TAGS = set("nav footer aside form menu dialog head".split())
ASIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert sidebar comment comments respond replies disqus menu nav navbar navigation breadcrumb "
    "breadcrumbs share sharing social related recommended widget popup modal newsletter subscribe signup login "
    "footer masthead pagination pager toolbar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACE = re.compile(r"\s+")
#: A class is frequent if one page in so many has it, and at least two do where there are two.
SUPPORT = 100


def _signature(tag: str, attributes: str) -> tuple[str, bool]:
    """Name of the element in paths, and whether its words set it aside."""
    words: list[str] = []
    classes = ""
    if "=" in attributes:
        for kind, *value in ATTRIBUTE.findall(attributes):
            value = next((v for v in value if v), "")
            words += re.split(r"[^a-z0-9]+", value.lower())
            if kind.lower() == "class":
                classes = ".".join(sorted(c for c in value.lower().split() if not any(x.isdigit() for x in c)))
    return (f"{tag}.{classes}" if classes else tag), bool(ASIDE_WORDS.intersection(words))


def parse(page: str) -> tuple[Counter, list[tuple[str, str, bool]]]:
    """Occurrences of each element path, in order of the first, and the blocks: (path, text, set aside)."""
    seen, blocks, _ = parse_links(page)
    return seen, blocks


def parse_links(page: str) -> tuple[Counter, list[tuple[str, str, bool]], list[int]]:
    """What `parse` gives, and how many characters of each block stand in links."""
    stack: list[tuple[str, str, bool]] = []  # tag, path, set aside
    seen: Counter = Counter()
    blocks: list[tuple[str, str, bool]] = []
    links: list[int] = []
    text: list[str] = []
    linked = 0
    in_link = False
    place = ("", False)

    def close_block():
        nonlocal linked, in_link
        if text:
            whole = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                blocks.append((place[0], whole, place[1]))
                links.append(linked)
            text.clear()
        linked, in_link = 0, False

    def top():
        return (stack[-1][1], stack[-1][2]) if stack else ("", False)

    at = 0
    size = len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            text.append(page[at:])
            break
        if found.start() > at:
            text.append(page[at : found.start()])
            if in_link:
                linked += found.start() - at
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        closing, attributes = found.group(1), found.group(3)
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        if closing:
            if tag in RAW:
                continue
            if any(tag == t for t, _, _ in stack):
                close_block()
                while stack.pop()[0] != tag:
                    pass
                place = top()
            continue
        if tag in RAW:
            close_block()
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        close_block()
        if tag in BLOCKS_END_P and any(t == "p" for t, _, _ in stack):
            while stack.pop()[0] != "p":
                pass
        elif tag in ("li", "td", "th", "tr", "option", "dt", "dd") and stack and stack[-1][0] in (
            {tag} if tag not in ("td", "th", "dt", "dd") else {"td", "th", "dt", "dd"}
        ):
            stack.pop()
        above, aside = top()
        name, named_aside = _signature(tag, attributes)
        path = f"{above}/{name}" if above else name
        seen[path] += 1
        if tag not in VOID:
            within = any(t in ("article", "main") for t, _, _ in stack)
            frame = tag in ("html", "body", "article", "main")
            aside = aside or (not frame and named_aside) or tag in ASIDE_TAGS or (tag == "header" and not within)
            stack.append((tag, path, aside))
        place = top()
    close_block()
    return seen, blocks, links


def host_of(url: str) -> Column:
    """Host of an address, lower case, without user and port; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))


def _tag(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


def valid_tokens(tokens: list[dict]) -> set[str]:
    """Paths of the tokens whose classes are valid: once in each page of the class, in one
    order, and nested, as all that is above them is valid as well."""
    sound = {t["path"] for t in tokens if t["once"] and t["ordered"]}
    return {p for p in sound if all(p[:i] in sound for i, c in enumerate(p) if c == "/")}


def deduce(tokens: list[dict]) -> dict | None:
    """The slots that hold the main text of a host's pages, `read`, the one with the most text
    first, and the slots within those that don't, `skip`.

    `tokens`: path, pages that have it, once and ordered (of its class), mass (varying text directly in it), links (how
    much of that stands in links) and texts (how many different ones) of the element tokens of one host.
    """
    template = valid_tokens(tokens)
    if not template:
        return None
    pages = {t["path"]: t["pages"] for t in tokens}
    slots: dict[str, list] = {}
    for t in tokens:
        path = t["path"]
        while path and (path not in template or _tag(path) in LEAVES):
            path = path.rpartition("/")[0]
        if path:
            slot = slots.setdefault(path, [0, 0, 0.0])
            slot[0] += t["mass"]
            slot[1] += t["links"]
            slot[2] = max(slot[2], t["texts"] / pages[path])
    ranked = sorted((p for p in slots if slots[p][0] > 0), key=lambda p: (-slots[p][0], p))
    if not ranked:
        return None
    # Lists of links, and what changes far less than the main text, are set aside.
    ranked = [p for p in ranked if slots[p][1] * 2 < slots[p][0] or _named(p)] or ranked
    varying = [p for p in ranked if slots[p][2] * 2 >= slots[ranked[0]][2]]
    read = list(dict.fromkeys(_named(p) or p for p in varying))
    inner = {p for p in template if _tag(p) not in LEAVES} - set(read)
    skip = sorted(p for p in inner if any(p.startswith(r + "/") for r in read if not _named(r)))
    return {"read": read, "skip": skip}


def _named(path: str) -> str | None:
    """The first article or main element of a path, if there is one."""
    parts = path.split("/")
    at = next((i for i, p in enumerate(parts) if p.split(".")[0] in ("article", "main")), None)
    return None if at is None else "/".join(parts[: at + 1])


def occurrences(pages: DataFrame) -> DataFrame:
    """A row for each path of each page (host, page, html): in which place it first stands, how
    often, the hash and length of the text directly in it, and how much of that is links.
    The empty path stands for the page."""

    def tokens(batch):
        out: dict = {k: [] for k in ("host", "page", "path", "at", "n", "text", "mass", "links")}
        for host, page, source in zip(
            batch.column("host").to_pylist(), batch.column("page").to_pylist(), batch.column("html").to_pylist(), strict=True
        ):
            seen, blocks, linked = parse_links(source)
            own: dict[str, list] = {}
            links: Counter = Counter()
            for (path, text, aside), part in zip(blocks, linked, strict=True):
                if not aside:
                    own.setdefault(path, []).append(text)
                    links[path] += part
            for at, (path, n) in enumerate([("", 1), *seen.items()]):
                texts = own.get(path, []) if path else []
                out["host"].append(host)
                out["page"].append(page)
                out["path"].append(path)
                out["at"].append(at)
                out["n"].append(n)
                out["text"].append(hash_of(texts) if texts else 0)
                out["mass"].append(sum(map(len, texts)))
                out["links"].append(links[path] if texts else 0)
        yield out

    return in_slices(
        pages, "host string, page long, path string, at int, n long, text long, mass long, links long", tokens
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, main) of pages (host, page, html): what `deduce` finds for each host, as JSON.

    What is gathered is one row for each frequent path of a host, with sums only.
    """
    found = shared_table(occurrences(pages), "occurrences")
    # The occurrence vector as sums of hashes of (page, times), 64 bits in two halves.
    share = F.xxhash64("page", "n")
    held = shared_table(
        found.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum("n").alias("times"),
            F.sum(F.shiftrightunsigned(share, 32)).alias("high_half"),
            F.sum(share.bitwiseAND(0xFFFFFFFF)).alias("low_half"),
            F.sum("mass").alias("all_mass"),
            F.sum("links").alias("links"),
            F.min("text").alias("low"),
            F.max("text").alias("high"),
            F.approx_count_distinct("text").alias("texts"),
        ),
        "tokens",
    )
    totals = held.where("path = ''").select("host", F.col("pages").alias("all_pages"))
    paths = held.where("path <> ''").join(totals, "host").select(
        "host",
        "path",
        F.concat_ws(":", "high_half", "low_half").alias("class"),
        (F.col("times") == F.col("pages")).alias("once"),
        ((F.col("pages") * SUPPORT >= F.col("all_pages")) & (F.col("pages") >= F.least("all_pages", F.lit(2)))).alias(
            "frequent"
        ),
        # Text that is the same on every page belongs to the template.
        F.when((F.col("low") == F.col("high")) & (F.col("pages") > 1), 0).otherwise(F.col("all_mass")).alias("mass"),
        "all_mass",
        "links",
        F.when(F.col("low") == F.col("high"), 0).otherwise(F.col("texts")).alias("texts"),
        "pages",
    )
    # Members of a class under one element stand in one order on all pages, or none of them is
    # valid; members under different elements are in the order of those.
    above = F.regexp_replace("path", "/?[^/]*$", "")
    siblings = (
        paths.where("frequent AND once")
        .groupBy("host", "class", above.alias("above"))
        .agg(F.collect_list("path").alias("members"))
        .where("size(members) > 1")
        .select("host", "class", "above", F.explode("members").alias("path"))
    )
    unordered = (
        found.select("host", "page", "path", "at")
        .join(siblings, ["host", "path"])
        .groupBy("host", "page", "class", "above")
        .agg(F.sort_array(F.collect_set(F.struct("at", "path")))["path"].alias("order"))
        .groupBy("host", "class", "above")
        .agg(F.min(F.xxhash64("order")).alias("least"), F.max(F.xxhash64("order")).alias("most"))
        .where("least <> most")
        .select("host", "class", "above", F.lit(True).alias("mixed"))
    )
    sums = ["pages", "mass", "all_mass", "links", "texts"]
    checked = (
        paths.where("frequent")
        .withColumn("above", above)
        .join(unordered, ["host", "class", "above"], "left")
        .select("host", "path", "once", F.col("mixed").isNull().alias("ordered"), *sums)
    )
    # What paths of few pages hold is credited to the nearest frequent one above.
    parts = F.split("path", "/")
    rare = (
        paths.where("NOT frequent AND all_mass > 0")
        .withColumn("rare", F.col("path"))
        .withColumn(
            "path",
            F.explode(
                F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
            ),
        )
        .join(paths.where("frequent").select("host", "path"), ["host", "path"])
        .groupBy("host", "rare")
        .agg(F.max_by("path", F.length("path")).alias("path"), *(F.first(c).alias(c) for c in sums))
        .withColumn("pages", F.lit(0))
        .withColumn("texts", F.greatest("texts", F.lit(1)))
        .select("host", "path", F.lit(False).alias("once"), F.lit(False).alias("ordered"), *sums)
    )
    per_path = (
        checked.unionByName(rare)
        .groupBy("host", "path")
        .agg(
            F.max("once").alias("once"),
            F.max("ordered").alias("ordered"),
            F.sum("mass").alias("mass"),
            F.sum("all_mass").alias("all_mass"),
            F.sum(F.when(F.col("mass") > 0, F.col("links")).otherwise(0)).alias("links"),
            F.max("pages").alias("pages"),
            F.sum("texts").alias("texts"),
        )
    )

    def per_host(keys, group):
        rows = group.to_pylist()
        found = deduce(rows) or deduce([r | {"mass": r["all_mass"]} for r in rows])
        return pa.table({"host": [keys[0].as_py()], "main": pa.array([found and json.dumps(found)], pa.string())})

    return per_path.groupBy("host").applyInArrow(per_host, "host string, main string")


def hash_of(texts: list[str]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\n".join(texts)) >> 1


def main_text(page: str, main: dict | None) -> str:
    """Blocks of the page that stand in its main slots and aren't set aside."""
    seen, blocks = parse(page)
    read = main["read"] if main else []
    present = [p for p in read if p in seen]
    first = present[0] if present else None
    if first is None or first != read[0]:
        # Another layout than that of the most text; an article or main element tells best.
        own = min((p for p in seen if _tag(p) in ("article", "main")), key=len, default=None)
        first = next((p for p in present if _named(p)), own or first)
    if first is None:
        return " ".join(text for _, text, aside in blocks if not aside)
    whole = first + "/"
    others = set() if _named(first) else set(present)
    known = others | set(main["skip"]) if others else others
    out = []
    for path, text, aside in blocks:
        if aside:
            continue
        if path != first and not path.startswith(whole):
            if not others:
                continue
            while path and path not in known:
                path = path.rpartition("/")[0]
            if path not in others:
                continue
        out.append(text)
    return " ".join(out)


def extract(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text (empty if there is none).

    Pages of one host share a template, of which a page has the classes of its layout; addresses without
    a host are one host. A page that lacks all main slots of the template is read by its own article or main element, or
    else whole, without menus and the like. Character references are decoded, white
    space within a block becomes one space, and blocks are joined by one space in the order of
    the page. Null pages are empty, repeated pages count as often as they stand there,
    and an empty table gives none.
    """
    pages = df.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html")
    ).withColumn("host", host_of("url"))
    found = shared_table(
        templates(pages.where("html <> ''").select("host", F.xxhash64("page_id", "url", "html").alias("page"), "html")), "templates"
    )
    joined = pages.join(found, "host", "left")
    kind = dict(pages.dtypes)["page_id"]

    def work(batch):
        known = {m: m and json.loads(m) for m in batch.column("main").unique().to_pylist()}
        texts = [
            main_text(p, known[m])
            for p, m in zip(batch.column("html").to_pylist(), batch.column("main").to_pylist(), strict=True)
        ]
        yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts}

    return in_slices(
        joined.select("page_id", "url", "html", "main"), f"page_id {kind}, url string, text string", work
    )
