"""A forgiving reader of one HTML page: its containers, their scores and the text inside chosen ones."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from functools import lru_cache

# fixed values: element names of the HTML standard, by how they behave
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CONTAINER = frozenset("html body article main section div td center blockquote details figure fieldset".split())
#: Which open elements a start tag closes, unless one of STOPS lies between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
STOPS = frozenset("ul ol dl table select div section article main body html td aside nav header footer form".split())
BARRIERS = frozenset("article main td body".split())
ENDS_PARAGRAPH = BLOCK - frozenset("br caption body html option optgroup legend summary tbody td tfoot th thead tr figcaption".split())

# parts of a page that are not its article: elements, roles, and words of class and id names
DROPPED = frozenset(
    "head nav footer aside script style noscript template iframe svg math button select textarea title label "
    "object canvas audio video menu datalist".split()
)
#: Not part of the article either, unless they enclose it, as some pages' forms and headers do.
MOSTLY_DROPPED = frozenset("header form dialog".split())
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert menu menubar toolbar form".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside header masthead footer cookie cookies consent gdpr notice "
    "notices banner ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus respond "
    "replies reply widget toolbar pagination pager hidden".split()
)
#: Of these the words of what readers wrote.
COMMENT_WORDS = frozenset("comment comments disqus respond replies reply".split())
KEPT = frozenset("html body main article".split())
# a name with one of these tells of a neighbour or child (has-sidebar), one that begins or ends with LAYOUT of how a box is laid out
LINKING = frozenset("has with no without".split())
LAYOUT = frozenset("overflow layout wrap wrapper border outline backface".split())
#: An article or main counts from this share of the page's prose on.
LEAST_PROSE = 0.1

#: A path keeps its innermost steps; those further out become one.
PATH_STEPS = 16

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _names_part(words: list[str]) -> bool:
    """Whether a class or id of these words says that its element is not part of the article: by its first word or its last."""
    if LINKING.intersection(words) or words[0] in LAYOUT or words[-1] in LAYOUT or words[:2] == ["share", "price"]:
        return False
    return words[0] in DROPPED_WORDS or words[-1] in DROPPED_WORDS


@lru_cache(maxsize=20_000)
def _traits(tag: str, attributes: str) -> tuple[bool, int, str]:
    """Whether an element is not part of the article for sure, or (1) by a name, role or style of its, or (2) by a name of such words only, or (3) as
    one that tells of readers' comments; and its step in a generalised path."""
    found = {}
    for name, value in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    classes = found.get("class", "").split()
    step = ".".join([tag, *sorted({re.sub(r"\d+", "#", c.lower()) for c in classes})])
    if tag in DROPPED:
        return True, 0, step
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    hidden = hidden or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None
    names = [[w.lower() for w in WORD.findall(name)] for name in [*classes, found.get("id", "")] if ":" not in name]
    # sm:hidden and the like hold for some screens only
    against = [words for words in names if words and _names_part(words)]
    named = 0
    if tag not in KEPT:
        named = max((2 if DROPPED_WORDS.issuperset(words) else 1 for words in against), default=0)
        if tag in MOSTLY_DROPPED or found.get("role", "").lower() in DROPPED_ROLES:
            named = max(named, 1)
    if hidden:
        named = max(named, 1)
    if tag not in ("html", "body", "main") and any(COMMENT_WORDS.intersection((words[0], words[-1])) for words in against):
        named = 3
    return False, named, step


class _Part:
    """An article or main, or an element that a name speaks against: where it lies and how much prose is in it."""

    def __init__(self, tag: str, named: int, start: int, prose: int):
        self.tag, self.named, self.start, self.end, self.prose = tag, named, start, None, -prose

    def holds(self, other: _Part) -> bool:
        return self is not other and self.start < other.start and other.end <= self.end

    @property
    def comments(self) -> bool:
        return self.named == 3


class Page:
    """One pass over a page. ``target`` is the path whose elements' text is wanted.

    Text inside a block runs on; blocks and line breaks part it. Markup, comments and the parts that
    :data:`DROPPED` and the like name are left out. Unclosed and stray tags are taken as browsers mostly do.

    A class, id, role or style drops no element that encloses the page's article or main, or most of its prose, and neither do a form or a header: such a
    page is read once more. Readers' comments are dropped however long they are, unless the page has nothing else.
    """

    def __init__(self, source: str, target: str | None = None):
        self._read(source, target, frozenset())
        spared = self._spared()
        if spared:
            self._read(source, target, spared)

    def text(self) -> str:
        return " ".join("".join(self.inside).split())

    def best(self) -> str | None:
        """The path of the container with the highest score, of equal ones the first by name."""
        return min(self.scores, key=lambda p: (-self.scores[p], p)) if self.scores else None

    def held(self) -> dict[str, int]:
        """Path -> prose in its elements and in those within; that of the whole page under the empty path."""
        held = {path: self.direct.get(path, 0) for path in ["", *self.parents]}
        # a path is met after that of the container above
        for path in reversed(self.parents):
            held[self.parents[path]] += held[path]
        return held

    def widened(self, path: str, inside_only: bool = False) -> str:
        """The container above ``path`` that holds the article's other parts too.

        An article, or main around no article, is taken whole. Beyond it (unless ``inside_only``) a container above is
        taken where at least LEAST_PROSE of its prose is beside what is held so far."""
        held = self.held()
        if path not in held:
            return path
        at = path
        while at:
            at = self.parents[at]
            kinds = {step.split(".")[0] for step in at.split(">")}
            within = "article" in kinds or "main" in kinds and not re.search(r"(^|>)article(\.|>|$)", path)
            if held[at] > held[path] and (within or not inside_only and held[at] - held[path] >= LEAST_PROSE * held[at]):
                path = at
        return path

    def _spared(self) -> frozenset[int]:
        """Where the elements begin that names speak against, but that must be the article or enclose it."""
        against = [p for p in self.parts if p.named and p.prose]
        if not against:
            return frozenset()
        # an article within readers' comments is one of them
        comments = [p for p in against if p.comments]
        chosen = [p for p in self.parts if not p.named and p.prose >= max(LEAST_PROSE * self.prose, 1)]
        chosen = [p for p in chosen if not any(c.holds(p) for c in comments)]
        written = sum(c.prose for c in comments if not any(d.holds(c) for d in comments))
        mains = [max((p for p in chosen if p.tag == tag), key=lambda p: p.prose, default=None) for tag in ("article", "main")]

        def spare(part: _Part) -> bool:
            if any(m and part.holds(m) for m in mains):
                return True
            if part.comments:
                return part.prose == self.prose
            # readers' comments are no measure of what is the article
            inside = sum(c.prose for c in comments if part.holds(c))
            prose, whole = part.prose - inside, self.prose - written
            beside = max((c.prose - part.prose * c.holds(part) for c in chosen), default=0)
            most = 0.5 if part.named == 1 else 1 - LEAST_PROSE
            return prose > most * whole and beside < 2 * LEAST_PROSE * self.prose

        return frozenset(p.start for p in against if spare(p))

    def _read(self, source: str, target: str | None, spared: frozenset[int]) -> None:
        self.scores: dict[str, float] = {}
        self.inside: list[str] = []
        # prose right in a container, and each container's one above, in order of appearance
        self.direct: dict[str, int] = {}
        self.parents: dict[str, str] = {}
        self.parts: list[_Part] = []
        self.prose = 0
        # of each open element: tag, dropped, path of its container, path of the container above, in a link, in the target, dropped for
        # sure, part
        stack: list[tuple] = [("", False, "", "", False, target == "", False, None)]
        opened = Counter()
        at = 0
        while at < len(source):
            match = TAG.search(source, at)
            end = match.start() if match else len(source)
            if end > at:
                self._text(source[at:end], stack[-1])
            if not match:
                break
            start, at = match.start(), match.end()
            closing, name, attributes = match.groups()
            if name is None:
                continue
            tag = name.lower()
            if tag in BLOCK and stack[-1][5]:
                self.inside.append(" ")
            if closing:
                self._close(stack, opened, tag, start)
                continue
            self._imply(stack, opened, tag, start)
            _, dropped, path, above, linked, wanted, surely, _ = stack[-1]
            plain = not attributes.strip(" /\t\n\r")
            sure, named, step = _traits(tag, "" if plain else attributes)
            lost = sure or named > 0 and start not in spared
            if not dropped and tag in CONTAINER:
                above, path = path, f"{path}>{step}" if path else step
                if path.count(">") >= PATH_STEPS:
                    # unlike outer steps stay unlike
                    first, second, inner = path.split(">", 2)
                    path = f"~{zlib.crc32(f'{first}>{second}'.encode()):08x}>{inner}"
                if path != above:
                    self.parents.setdefault(path, above)
                wanted = wanted or path == target
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = close.start() if close else len(source)
            if tag in VOID or attributes.endswith("/") and tag in ("path", "circle", "rect", "use"):
                continue
            opened[tag] += 1
            part = None
            if not (surely or sure) and (named or tag in ("article", "main")):
                part = _Part(tag, named, start, self.prose)
                self.parts.append(part)
            gone = dropped or lost
            stack.append((tag, gone, path, above, linked or tag == "a", wanted and not gone, surely or sure, part))
        self._cut(stack, opened, 1, len(source))

    def _text(self, raw: str, element: tuple) -> None:
        tag, dropped, path, above, linked, wanted, surely, _ = element
        if surely or tag in RAW:
            return
        text = html.unescape(raw) if "&" in raw else raw
        size = 0 if linked else len(text.strip())
        self.prose += size
        if dropped:
            return
        if wanted:
            self.inside.append(text)
        if size:
            self.direct[path] = self.direct.get(path, 0) + size
            self.scores[path] = self.scores.get(path, 0) + size
            if path != above:
                self.scores[above] = self.scores.get(above, 0) + size / 2

    def _cut(self, stack: list, opened: Counter, depth: int, at: int) -> None:
        for element in stack[depth:]:
            opened[element[0]] -= 1
            self._end(element[-1], at)
        del stack[depth:]

    def _end(self, part: _Part | None, at: int) -> None:
        if part is not None:
            part.end = at
            part.prose += self.prose

    def _close(self, stack: list, opened: Counter, tag: str, at: int) -> None:
        if opened[tag] <= 0:
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == tag:
                self._cut(stack, opened, depth, at)
                return
            if stack[depth][0] in BARRIERS and tag not in BLOCK:
                return  # a stray inline end tag closes nothing outside its block

    def _imply(self, stack: list, opened: Counter, tag: str, at: int) -> None:
        if tag in ENDS_PARAGRAPH and opened["p"] > 0:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    self._cut(stack, opened, depth, at)
                    break
                if stack[depth][0] in STOPS:
                    break
        closes = CLOSES.get(tag)
        if closes and any(opened[c] > 0 for c in closes):
            found = None
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closes:
                    found = depth
                elif stack[depth][0] in STOPS and stack[depth][0] not in closes:
                    break
            if found:
                self._cut(stack, opened, found, at)
