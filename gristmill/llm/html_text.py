"""Operator 4: the main text of web pages, by paths that the pages of a host agree on."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import arrow_rows, stored

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a block of text.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
#: Elements that can hold the main text.
CONTAINER = frozenset("article body div main section td".split())
#: Elements whose content is never main text.
DROPPED = frozenset(
    "aside audio button canvas dialog footer head iframe input label map menu nav noscript object option "
    "script select style svg template textarea title video".split()
)
#: Elements that go as those with a mark do: some frameworks put the whole page into a form, and an article's own header
#: holds its title.
MARKED = frozenset(["form", "header"])
#: Words in class, id or role that mark menus, notices, adverts, comments and the like.
MARKS = frozenset(
    "ad ads adv advert advertisement adverts advertorial alert banner breadcrumb breadcrumbs byline comment comments "
    "consent cookie cookies disclaimer discussion disqus footer form gdpr header hidden login masthead menu menubar "
    "modal nav navbar navigation newsletter notice notification notices pager pagination paywall popup promo promoted "
    "promotion related replies reply respond response share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription survey tags teaser toc toolbar widget widgets".split()
)
#: Elements that an opening element ends, up to the elements that hold them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Characters outside links from which a block counts as prose, and the share of the article that text beside it in
#: the body must have to belong to it.
PROSE, BESIDE = 40, 0.25
_TOKEN = re.compile(r"[a-z]+|\d+")
_SCOPE = frozenset({"table", "td", "th", "body", "html"})


#: Words of a class name behind which the rest says what else the page has, or has not.
_BESIDE = frozenset("has no not with without".split())


def _tokens(value: str) -> list[str]:
    """Words of class names and ids in lower case: ``adBox-1`` has ad, box, 1, and ``page-with-nav`` has page."""
    found = []
    for name in value.split():
        for word in _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()):
            if word in _BESIDE:
                break
            found.append(word)
    return found


class Page(HTMLParser):
    """The containers of a page and its blocks of text, each with the container that holds it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        # Open elements: tag, container that holds their text, inside something dropped, inside a link, innermost
        # marked element around them, and whether they are that element.
        self.open: list[tuple[str, int, bool, bool, int, bool]] = []
        self.parents, self.paths, self.tags = [-1], [""], [""]
        # Container, words, characters inside links, whether it is a title; the marked element around each.
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.marked: list[int] = []
        # Marked elements: the one around, and what tells a layout wrapper: 2 for main, 1 for an article or a title.
        self.outer: list[int] = []
        self.holds: list[int] = []
        # Whether it is the header of an article.
        self.heads: list[bool] = []
        self.text: list[str] = []
        self.linked = 0
        self.feed(html)
        self.close()
        self._break()
        kept = self._wrappers()
        if kept is not None:
            # Of the header of an article its title stays.
            titled = [h and (o < 0 or kept[o]) for h, o in zip(self.heads, self.outer)]
            self.blocks = [b for b, m in zip(self.blocks, self.marked) if m < 0 or kept[m] or b[3] and titled[m]]

    def _state(self) -> tuple[int, bool, bool, int]:
        return self.open[-1][1:5] if self.open else (0, False, False, -1)

    def _wrappers(self) -> list[bool] | None:
        """Of the marked elements, those that stay with all around them; None if there is no marked element.

        An element that holds the main element stays, as does one that holds an article or a title and most of the
        prose that is not in other marked elements. If no text were left, one that holds most of the prose stays,
        and one inside of it only where nearly all stands in that.
        """
        if not self.outer:
            return None
        n = len(self.outer)
        own, all_prose, bare = [0.0] * n, 0.0, True
        live = [False] * n
        for i in range(n):
            live[i] = self.holds[i] > 0 and (self.outer[i] < 0 or live[self.outer[i]])
        whole, total = [0.0] * n, 0.0
        for (_, words, linked, _), m in zip(self.blocks, self.marked):
            size = max(0.0, len(words) - 2.0 * linked)
            all_prose += size
            if m < 0:
                bare = bare and not size
            else:
                own[m] += size
            if m < 0 or live[m]:
                total += size
                if m >= 0:
                    whole[m] += size
        for i in range(n - 1, -1, -1):
            if self.outer[i] >= 0:
                own[self.outer[i]] += own[i]
                whole[self.outer[i]] += whole[i]
        kept = [False] * n
        for i in range(n):
            fits = live[i] and (self.holds[i] > 1 or 2 * whole[i] > total)
            kept[i] = fits and (self.outer[i] < 0 or kept[self.outer[i]])
        if bare and not any(kept):
            for i in range(n):
                around = self.outer[i]
                fits = own[i] >= PROSE and 2 * own[i] > all_prose
                kept[i] = fits and (around < 0 or kept[around] and own[around] - own[i] < PROSE)
        return kept

    def _break(self) -> None:
        words = " ".join("".join(self.text).split())
        if words:
            self.blocks.append((self.at, words, self.linked, self.title))
            self.marked.append(self.mark)
        self.text, self.linked = [], 0

    at, title, mark = 0, False, -1

    def _end(self, index: int) -> None:
        if any(e[0] in BLOCK or e[2] or e[5] for e in self.open[index:]):
            self._break()
        del self.open[index:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            if tag == "hr":
                self._break()
            return
        if tag in BLOCK:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._end(i)
                    break
                if self.open[i][0] in BLOCK and self.open[i][0] not in ("p",):
                    break
        if tag in ENDS:
            ended, scope = ENDS[tag]
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in scope:
                    break
                if self.open[i][0] in ended:
                    self._end(i)
                    if tag not in ("tr", "td", "th") or self.open and self.open[-1][0] not in ended:
                        break
        holder, dropped, linked, mark = self._state()
        begins = False
        names = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
        if tag not in ("html", "body", "article", "main"):
            words = _tokens(f"{names.get('class', '')} {names.get('id', '')} {names.get('role', '')}")
            dropped = dropped or tag in DROPPED or "hidden" in names or names.get("aria-hidden") == "true"
            begins = not dropped and (tag in MARKED or not MARKS.isdisjoint(words))
        if tag in BLOCK or dropped or begins:
            self._break()
        if begins:
            self.outer.append(mark)
            self.holds.append(0)
            self.heads.append(tag == "header" and any(e[0] in ("article", "main") for e in self.open))
            mark = len(self.outer) - 1
        if tag in ("article", "main", "h1") and not dropped and mark >= 0:
            of_main = tag == "main"
            # The article of a comment or a teaser says so itself.
            if of_main or MARKS.isdisjoint(_tokens(f"{names.get('class', '')} {names.get('id', '')}")):
                i = mark
                while i >= 0 and self.holds[i] < 1 + of_main:
                    self.holds[i] = 1 + of_main
                    i = self.outer[i]
        if tag in CONTAINER:
            classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in names.get("class", "").split()})
            label = ".".join([tag, *classes])
            self.parents.append(holder)
            self.paths.append(f"{self.paths[holder]}>{label}" if self.paths[holder] else label)
            self.tags.append(tag)
            holder = len(self.paths) - 1
        self.open.append((tag, holder, dropped, linked or tag == "a", mark, begins))

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._end(i)
                return
            if self.open[i][0] in _SCOPE and tag not in ("body", "html", "table", "tr"):
                return

    def handle_data(self, data: str) -> None:
        holder, dropped, linked, mark = self._state()
        if not dropped:
            if not self.text:
                self.at, self.mark = holder, mark
                self.title = any(e[0] == "h1" for e in self.open)
            self.text.append(data)
            self.linked += len(data) if linked else 0

    def best(self) -> tuple[str, float]:
        """Path of the article and score of its best container: prose counts, links count against it."""
        scores = [0.0] * len(self.paths)
        for holder, words, linked, _ in self.blocks:
            gain = len(words) - 2.0 * linked
            scores[holder] += gain
            if holder:
                scores[self.parents[holder]] += gain / 2
        ranked = [
            (s * (1.5 if self.tags[i] in ("article", "main") else 1.0), -i) for i, s in enumerate(scores)
        ]
        score, place = max(ranked)
        return self.paths[self._whole({-place}, True).pop()], score

    def _inside(self, tops: set[int]) -> list[bool]:
        inside = [False] * len(self.paths)
        for i in range(len(self.paths)):
            inside[i] = i in tops or i > 0 and inside[self.parents[i]]
        return inside

    def _whole(self, parts: set[int], body: bool) -> set[int]:
        """The containers that hold the rest of the articles of which these are parts.

        That is the nearest article or main around a part. Without one it is the highest container below the body that
        adds prose or a title to what its parts hold. If there is none, and ``body`` allows it, it is the body, where
        the prose beside the part is ``BESIDE`` of it or more.
        """
        inside = self._inside(parts)
        own, count, gain = 0.0, [0] * len(self.paths), [0.0] * len(self.paths)
        for holder, words, linked, title in self.blocks:
            size = len(words) - 2.0 * linked
            if inside[holder]:
                own += size
            elif title or size >= PROSE:
                count[holder] += 1
                gain[holder] += size
        for i in range(len(self.paths) - 1, 0, -1):
            count[self.parents[i]] += count[i]
            gain[self.parents[i]] += gain[i]
        out = set()
        for part in parts:
            chain = [part]
            while chain[-1]:
                chain.append(self.parents[chain[-1]])
            found = next((i for i in chain if self.tags[i] in ("article", "main")), None)
            if found is None:
                found = part
                for i in chain[1:]:
                    if self.tags[i] not in ("", "body"):
                        found = i if count[i] > count[found] else found
                    elif body and found == part and count[i] > count[found] and gain[i] >= BESIDE * own:
                        found = i
            out.add(found)
        return out

    def under(self, path: str) -> str | None:
        """Text of all containers on that path and of the articles that they are parts of, blocks joined by spaces.

        None if there is no such container.
        """
        tops = {i for i in range(len(self.paths)) if self.paths[i] == path}
        if not tops:
            return None
        inside = self._inside(self._whole(tops, False))
        return " ".join(words for holder, words, _, _ in self.blocks if inside[holder])


def host_of(url: str | None) -> str:
    """The host of an address in lower case, without a port; empty where there is none."""
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def _votes(columns: list[list]) -> list:
    """One row per host and path of a batch."""
    votes: dict[tuple[str, str], list[float]] = {}
    for url, raw in zip(*columns):
        path, score = Page(_text(raw)).best()
        if score > 0:
            vote = votes.setdefault((host_of(url), path), [0, 0.0])
            vote[0] += 1
            vote[1] += score
    return [[h for h, _ in votes], [p for _, p in votes], [int(n) for n, _ in votes.values()], [s for _, s in votes.values()]]


def _extract(columns: list[list]) -> list:
    texts = []
    for raw, path in zip(columns[2], columns[3]):
        page = Page(_text(raw))
        text = page.under(path) if path is not None else None
        if text is None:
            own, score = page.best()
            text = (page.under(own) or "") if score > 0 else ""
        texts.append(text)
    return [columns[0], columns[1], texts, [len(t) for t in texts]]


#: Hosts up to which the winning paths are sent to every task; more are joined by a shuffle.
SENT_HOSTS = 100_000


def main_text(pages: DataFrame) -> DataFrame:
    """The article of every page: page_id, url, text, n_chars.

    ``pages`` needs page_id, url and html. One row per input row. Menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and reader comments go, by element and by the words in class, id and role (but
    not for such words on an element that holds the article: main, or an article or title and most of the prose);
    character references are decoded; white space in a block becomes one space, and blocks are joined by one.
    A null or empty html, or one without text, gives an empty text. Addresses without a host are one host.
    Repeated rows are alike, each votes; other columns are ignored.

    Every page scores its containers and votes for the path (tags and classes, digits generalised) of the article
    that the best is a part of: the article or main around it, or else the container that adds prose or a title;
    votes are counted per host, a tie goes to the larger score and then the last path. The winning path is then
    extracted from every page of the host, with what the page's own article adds to it; a page without such a
    container gives its own best one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    votes = arrow_rows(rows.select("url", "html"), _votes, "host string, path string, n long, score double", ("html",))
    votes = votes.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("score").alias("score"))
    best = F.max_by("path", F.struct("n", F.round("score"), "path")).alias("path")
    winners = stored(votes.groupBy("host").agg(best), "host-paths")
    if winners.count() <= SENT_HOSTS:
        winners = F.broadcast(winners)
    address = F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = rows.withColumn("host", F.coalesce(address, F.lit(""))).join(winners, "host", "left")
    schema = "page_id long, url string, text string, n_chars long"
    return arrow_rows(rows.select("page_id", "url", "html", "path"), _extract, schema, ("html",))
