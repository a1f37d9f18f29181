"""Main text of HTML pages: parser events, text-to-tag ratios, content regions.

1. The standard library's parser streams a page's events into lines, one per
   block element, with the line's text, its tags and the container it stands
   in. Scripts, styles, menus, page headers, footers, sidebars, notices,
   adverts, forms and reader comments (by element, role, or the last word of a
   class or id, numbers and joined words read) give no lines. By role, class or id, and
   as forms, they do where the article is in them: see ``kept``. Inside an article or
   main element a name skips no inline element and no heading, and of blocks only
   adverts, reader comments and sign-ups; any other named block is judged, see 3.
2. A line's ratio is its characters over its tags (at least one). The ratios are
   smoothed along the page by a Gaussian; lines whose smoothed ratio is at least
   the standard deviation of all smoothed ratios are content, which splits the
   page into content and other clusters.
3. The region is the article or main element with the most content text, with the
   articles beside it (same parent) that are not mostly links; on
   pages without one, the container reached from the top by following the child
   that holds at least ``DOMINANT`` of the content text. All lines of the region
   are kept, also short ones between long ones (without article or main: not
   those that are no content and mostly links).

Character references are decoded, white space inside a block becomes one space,
blocks are trimmed and joined by one line break.

Defined results: null and empty html, and pages without any content line, give
the empty text; unclosed and stray tags are read as browsers do in the cases
that matter here (an open paragraph ends at the next block, also where it or a
list item is skipped); broken markup
never raises; pages of any size are read whole; repeated rows each give a row.
"""
from __future__ import annotations

import math
import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches

SIGMA, RADIUS, DOMINANT, LINKS, LIKE = 1.0, 2, 0.8, 0.5, 0.5

# --- fixed values: names of HTML ---------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s
    samp small span strike strong sub sup time tt u var wbr img br""".split())
SKIPPED = frozenset("""script style noscript template head title nav footer aside form button select option textarea
    iframe object svg math canvas audio video dialog menu""".split())
SKIPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog menu
    menubar status note toolbar""".split())
MAIN = frozenset(("article", "main"))
#: Words of a class or id that mark what is no article text.
SKIPPED_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo
    promotion banner nav navbar navigation menu menubar submenu breadcrumb breadcrumbs pagination pager toc header
    masthead topbar footer foot copyright sidebar aside rail widget widgets notice notices notification alert warning
    cookie cookies consent gdpr privacy popup modal overlay newsletter subscribe subscription signup login register
    search form share sharing social related recommended comment comments commentlist respond response responses reply
    replies disqus discussion""".split())
#: First words of a class that say what a page has, not what the element is.
STATE_WORDS = frozenset(("has", "with", "no", "is", "without", "js", "category", "tag"))
#: Last words that name a part or place; the word before them says what it is.
PART_WORDS = frozenset("""container wrapper wrap area box list section block inner outer left right top bottom bar
    button buttons link links item items group unit slot posts thread threads feed body x px""".split())
#: Skipped words of layouts, which may stand around the whole article.
LAYOUT_WORDS = frozenset("""sidebar aside rail header masthead topbar nav navbar navigation menu menubar widget widgets
    form search""".split())
#: Skipped words of what can hold articles, or more text than the article, of its own.
OTHER_TEXT = frozenset("""cookie cookies consent gdpr privacy popup modal overlay related recommended comment comments
    commentlist respond response responses reply replies disqus discussion""".split())
#: Skipped words that also skip a block inside an article; beginnings of joined words.
NEVER_ARTICLE = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo
    promotion comment comments commentlist respond response responses reply replies disqus discussion newsletter consent
    gdpr signup subscribe""".split())
JOINED = {"adsby": "ads", "adsense": "ads", "advert": "advert", "googlead": "ads", "comment": "comments", "disqus": "disqus"}
#: Why an element is skipped: whatever it holds; unless a main element, an article,
#: or most of the text is in it (each also for what stands before it).
ALWAYS, MAIN_SAVES, ARTICLE_SAVES, SIZE_SAVES = 4, 3, 2, 1
#: It is in an article and is judged by its lines.
JUDGED = -1
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements whose start ends an open element of the same kind.
_ENDS_OWN = frozenset("li dt dd tr td th option".split())


def named_part(part: str) -> str | None:
    """The skipped word that a class or id says of its element."""
    words = [w.lower() for w in _WORDS.findall(part)]
    if not words or words[0] in STATE_WORDS:
        return None
    while len(words) > 1 and words[-1] in PART_WORDS:
        words.pop()
    word = words[-1]
    return next((v for k, v in JOINED.items() if word.startswith(k)), word if word in SKIPPED_WORDS else None)


def skipped(tag: str, attrs: list, inside: bool = False, nested: bool = False) -> int:
    """Whether and why (0: not) an element holds no article text, by its name, role,
    class or id; ``inside`` an article or main element, ``nested`` in an article."""
    why = SIZE_SAVES if tag == "form" else ALWAYS if tag in SKIPPED else 0
    if why == ALWAYS or not attrs or tag in ("html", "body", "main"):
        return why
    named = tag not in MAIN and not is_main(tag, attrs) or nested and tag == "article"
    for name, value in attrs:
        if name == "hidden" or name == "style" and _HIDDEN.search(value or ""):
            return ALWAYS
        if not named or inside and (tag in INLINE or tag in HEADINGS):
            continue
        if name == "role" and (value or "").lower() in SKIPPED_ROLES:
            why = max(why, SIZE_SAVES if value.lower() in ("form", "search") else MAIN_SAVES)
        if name in ("class", "id"):
            for word in map(named_part, (value or "").split()):
                if not word or tag == "article" and word not in OTHER_TEXT:
                    continue
                if inside and word not in NEVER_ARTICLE:
                    why = why or JUDGED
                else:
                    why = max(why, MAIN_SAVES if word in OTHER_TEXT else
                              SIZE_SAVES if word in LAYOUT_WORDS else ARTICLE_SAVES)
    return why


def is_main(tag: str, attrs: list) -> bool:
    return tag == "main" or (dict(attrs).get("role") or "").lower() == "main"


class Lines(HTMLParser):
    """Collects lines: text, tags, characters inside links, container number."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list = []
        self.stack: list = []          # open elements: (tag, container number)
        self.parent = [-1]             # container numbers; 0 is the page
        self.is_main = [False]
        self.mains: set = set()        # containers of main elements (not of articles)
        self.articles: set = set()     # containers of article elements
        self.judged: list = []         # named containers inside an article
        self.doubt: dict = {}          # container -> why it may be skipped
        self.doubted: list = []        # open ones: place in the stack, counts before them
        self.off = 0                   # depth of the skipped element in the stack + 1
        self.header = 0                # likewise, of a header inside the article
        self.heading = False
        self.text: list = []
        self.tags = self.link_chars = self.links = 0

    def here(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def flush(self):
        if self.text:
            t = " ".join("".join(self.text).split())
            self.text.clear()
            if t:
                self.lines.append((t, self.tags, self.link_chars, self.here()))
                self.tags = self.link_chars = 0

    def push(self, tag, attrs, why=0):
        number = self.here()
        if why or tag not in INLINE and tag != "p" and tag not in HEADINGS:
            main = is_main(tag, attrs)
            self.parent.append(number)
            self.is_main.append(main or tag in MAIN)
            number = len(self.parent) - 1
            if main:
                self.mains.add(number)
            if tag == "article":
                self.articles.add(number)
            if why == JUDGED:
                self.judged.append(number)
            elif why:
                self.doubt[number] = why
                self.doubted.append((len(self.stack), self.tags, self.link_chars, self.links))
                self.tags = self.link_chars = 0
        self.stack.append((tag, number))

    def handle_starttag(self, tag, attrs):
        if self.off:
            if tag in VOID:
                return
            if tag not in INLINE:
                self.close_implied(tag)
            if self.off:
                self.stack.append((tag, self.here()))
                return
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self.flush()
            return
        if tag not in INLINE:
            self.flush()
            self.close_implied(tag)
        if tag in HEADINGS:
            self.heading = True
        if tag == "a":
            self.links += 1
        inside = nested = False
        if attrs or tag == "header":
            for n in self.chain():
                inside |= self.is_main[n]
                nested |= n in self.articles
        if inside and tag == "header":
            self.header = self.header or len(self.stack) + 1
        why = (0 if inside else ALWAYS) if tag == "header" else skipped(tag, attrs, inside, nested)
        if why:
            self.flush()
        self.push(tag, attrs, why if why < ALWAYS else 0)
        if why == ALWAYS:
            self.off = len(self.stack)

    def chain(self):
        n = self.here()
        while n >= 0:
            yield n
            n = self.parent[n]

    def cut(self, i):
        """Close the open elements from place ``i`` on, and what they switched off."""
        ends = [d for d in self.doubted if d[0] >= i]
        if ends:
            self.flush()
        del self.stack[i:]
        if self.off > i:
            self.off = 0
            self.tags += 1
        if self.header > i:
            self.header = 0
        if ends:
            del self.doubted[-len(ends):]
            _, self.tags, self.link_chars, self.links = ends[0]
            self.tags += 1

    def close_implied(self, tag):
        """The elements that the start of a block ends, also inside skipped ones."""
        if self.stack:
            self.close_paragraph()
            if tag in _ENDS_OWN:
                self.close_own(tag)

    def close_paragraph(self):
        """A block start ends an open paragraph and the inline elements in it."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag == "p":
                self.cut(i)
                return
            if tag not in INLINE:
                return

    def close_own(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.cut(i)
                return
            if self.stack[i][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "main", "body"):
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.off:
            self.tags += 1
            if tag not in INLINE:
                self.flush()
            if tag in HEADINGS:
                self.heading = False
            if tag == "a" and self.links:
                self.links -= 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in INLINE and not self.off and not self.doubted and any(t not in INLINE for t, _ in self.stack[i + 1:]):
                    return  # a stray end of an inline element does not close blocks
                self.cut(i)
                return

    def handle_data(self, data):
        if self.off or (self.header and not self.heading):
            return
        self.text.append(data)
        if self.links:
            self.link_chars += len(data)

    def finish(self):
        self.close()
        self.flush()
        return self


def parse(html: str) -> Lines:
    try:
        p = Lines()
        p.feed(html)
        return p.finish()
    except AssertionError:  # the parser gives up on some marked sections; read them as comments
        p = Lines()
        p.feed(html.replace("<![", "<! ["))
        return p.finish()


def smooth(values: list, sigma: float = SIGMA, radius: int = RADIUS) -> list:
    """Gaussian smoothing; at the ends the kernel is cut and weighted anew."""
    kernel = [math.exp(-d * d / (2 * sigma * sigma)) for d in range(radius + 1)]
    out, n = [], len(values)
    for i in range(n):
        lo, hi = max(0, i - radius), min(n, i + radius + 1)
        w = [kernel[abs(j - i)] for j in range(lo, hi)]
        out.append(sum(a * b for a, b in zip(w, values[lo:hi])) / sum(w))
    return out


def content(ratios: list) -> list:
    """Which lines belong to the content cluster."""
    s = smooth(ratios)
    mean = sum(s) / len(s)
    least = math.sqrt(sum((x - mean) ** 2 for x in s) / len(s))
    return [x >= least for x in s]


def kept(page: Lines) -> list:
    """The lines of a page without the elements that hold no article text. Such an
    element stays if a main element is in it; if an article is in it and either one
    is outside too or it has more text than all outside; or, of a layout or form,
    if more text is in it than outside. Text of links does not count."""
    if not page.doubt:
        return page.lines
    near, size = [], [0] * len(page.parent)  # innermost doubted container; text in it itself
    for n, p in enumerate(page.parent):
        near.append(n if n in page.doubt else near[p] if p >= 0 else -1)
    own: dict = {}
    for t, _, linked, n in page.lines:
        own[near[n]] = own.get(near[n], 0) + len(t) - linked
        size[n] += len(t) - linked
    article, main, within = {}, set(), dict(own)  # of doubted containers, at any depth
    for n in range(len(page.parent) - 1, -1, -1):
        p = page.parent[n]
        if page.is_main[n] and size[n]:
            s = near[n]
            article[s] = max(article.get(s, 0), size[n])
            if n in page.mains:
                main.add(s)
        up = near[p] if p >= 0 else -1
        why = page.doubt.get(n, 0)
        if n in main:
            main.add(up)
        if why and up >= 0 and (why < MAIN_SAVES or n in main):
            within[up] = within.get(up, 0) + within.get(n, 0)
            article[up] = max(article.get(up, 0), article.get(n, 0))
        if p >= 0 and (why < MAIN_SAVES or n in main):
            size[p] += size[n]
    alive, outside = {-1}, own.get(-1, 0)
    mains = {near[n] for n, m in enumerate(page.is_main) if m and size[n]}
    for n, why in page.doubt.items():
        up = near[page.parent[n]]
        if up in alive and (n in main or why < MAIN_SAVES and article.get(n) and (alive & mains or article[n] > outside)
                            or why == SIZE_SAVES and within.get(n, 0) > outside):
            alive.add(n)
            outside += own.get(n, 0)
    return [line for line in page.lines if near[line[3]] in alive]


def extract(html: str | None) -> str:
    """Main text of one page."""
    if not html:
        return ""
    page = parse(html)
    lines = kept(page)
    if not lines:
        return ""
    good = content([len(t) / max(1, tags) for t, tags, _, _ in lines])
    held: dict = {}  # container -> content characters in it, at any depth
    for (t, _, _, n), g in zip(lines, good):
        while g and n >= 0:
            held[n] = held.get(n, 0) + len(t)
            n = page.parent[n]
    # outermost article or main elements (containers are numbered parents first)
    inside, tops = {}, []
    for n, p in enumerate(page.parent):
        inside[n] = page.is_main[n] or inside.get(p, False)
        if page.is_main[n] and not inside.get(p, False):
            tops.append(n)
    tops = [n for n in tops if n in held]
    beside: set = set()
    if tops:
        region = max(tops, key=lambda n: (held[n], -n))
        beside = {n for n in tops if page.parent[n] == page.parent[region]}
    else:
        region, children = 0, {}
        for n in held:
            children.setdefault(page.parent[n], []).append(n)
        while True:
            best = max(children.get(region, []), key=lambda n: (held[n], -n), default=None)
            if best is None or held[best] < DOMINANT * held[region]:
                break
            region = best
    member, block, judged = {}, {}, set(page.judged)  # container -> its part of the region; its outermost judged one
    for n, p in enumerate(page.parent):
        member[n] = n if n == region or n in beside else member.get(p, -1)
        block[n] = block.get(p, -1) if block.get(p, -1) >= 0 else n if n in judged else -1
    sums: dict = {}  # (part of the region, judged block) -> lines, characters, tags, characters in links
    for t, tags, linked, n in lines:
        for of in {("part", member[n]), ("block", block[n])}:
            sums[of] = [a + b for a, b in zip(sums.get(of, (0, 0, 0, 0)), (1, len(t), max(1, tags), linked))]
    plain = [0, 0]
    for t, tags, _, n in lines:
        if member[n] >= 0 and block[n] < 0:
            plain = [plain[0] + len(t), plain[1] + max(1, tags)]

    def reads_like_it(n: int) -> bool:
        count, chars, tags, linked = sums["block", n]
        return not plain[1] or (count > 1 and linked <= LINKS * chars and chars / tags >= LIKE * plain[0] / plain[1])

    parts = {n for n in {region, *beside} if n == region or sums.get(("part", n), [0, 0, 0, 1])[3] <= LINKS * sums["part", n][1]}
    blocks = {-1} | {n for n in judged if ("block", n) in sums and reads_like_it(n)}
    return "\n".join(t for (t, _, linked, n), g in zip(lines, good)
                     if member[n] in parts and block[n] in blocks and (tops or g or linked <= LINKS * len(t)))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    d = bounded_batches(pages).select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in d.schema}
    return d.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
