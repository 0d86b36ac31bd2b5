"""Main text of HTML pages by two passes over blocks.

First pass: each block is good, bad or undecided by its links, length and share of stop words, and
by the element it is in (a menu is no text, an article is). Second pass: undecided blocks take
the label of the nearest decided neighbours.
"""

import html
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements by HTML's own meaning, and common function words of four languages.
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
# up to their end tag, or that of the page, all is theirs
RAW = set("script style textarea title iframe xmp noembed noframes".split())
# what is in them is no text, but an unclosed one ends with the element around it
SKIPPED = set("noscript template svg math object select button".split())
FOREIGN = set("svg math".split())  # a slash at the end closes them
OUTSIDE = set("nav header footer aside form menu dialog head".split())
INSIDE = set("article main".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words that, alone or with each other and with those that only say where or what kind of box, name something else
# than the text.
NOTICES = set(
    "ad ads advert adverts advertisement advertisements advertising banner banners promo promos promotion promoted sponsor sponsored "
    "sponsors cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription share sharing "
    "shares social related recommend recommended recommendations comment comments disqus reply replies respond sidebar widget widgets menu "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead copyright legal login signup search toc tags".split()
)
READERS = set("comment comments disqus reply replies respond".split())
BOXES = set(
    "site page main global top bottom left right inner outer upper lower box bar list lists area block container wrapper wrap section row "
    "col column item items posts links link buttons button slot unit panel group form icons icon title thread children body content "
    "primary secondary mobile desktop fixed sticky post entry the and of l r".split()
)


def _names(said):
    """Whether a class or an id names something else than the text, and whether readers' comments."""
    notice = readers = False
    for name in said.split():
        parts = [p for p in re.split(r"[\W_\d]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
        if parts and all(p in NOTICES or p in BOXES for p in parts):
            notice = notice or any(p in NOTICES for p in parts)
            readers = readers or any(p in READERS for p in parts)
    return notice, readers


ROLES = re.compile(r"navigation|banner|contentinfo|complementary|search|alert|dialog|menu|form", re.I)
STOP_WORDS = set(
    """
    a about after all also an and are as at be because been but by can could do for from had has have he her his i if in into
    is it its more my no not of on one or our she so some than that the their them then there they this to was we were what
    when which who will with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich
    ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wie wir zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais même nous on ou où par pas plus
    pour qu que qui sa se ses son sont sur un une vous
    al como con cuando de del desde donde el ella en entre era es esta este ha hay la las lo los más me mi muy no nos o para
    pero por porque que se ser si sin sobre su sus también un una y ya
    """.split()
)
NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
PART = re.compile(r"[^\s/>=][^\s/>=]*|=\s*")
UNQUOTED = re.compile(r"[^\s>]*")
GAP = re.compile(r"[\s/]*")


def _tag_end(page, at):
    """Where the tag whose attributes begin at `at` ends, behind its `>`; None if it never does. A quote opens a value
    only right after `=`; anywhere else it is a character like others."""
    size = len(page)
    while True:
        at = GAP.match(page, at).end()
        if at >= size:
            return None
        if page[at] == ">":
            return at + 1
        part = PART.match(page, at)
        at = part.end()
        if part[0][0] == "=":
            quote = page[at : at + 1]
            if quote in ("'", '"') and quote:
                at = page.find(quote, at + 1) + 1
                if not at:
                    return None
            else:
                at = UNQUOTED.match(page, at).end()


ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


@dataclass(frozen=True)
class Rules:
    """`short`, `long`: characters of a block; `links`: share of them in links; `low`, `high`: share of
    stop words among words."""

    short: int = 70
    long: int = 200
    links: float = 0.4
    low: float = 0.12
    high: float = 0.2


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    zone: str  # "in" an article, "out" of the text, or "" for neither
    part: int  # number of the article
    named: int = 0  # number of the outermost element around it whose name says that it is no text


@dataclass
class Open:
    """An element that is open, with what it inherits from those around it."""

    name: str
    zone: str = ""
    block: str = ""
    named: int = 0
    skipped: bool = False


def blocks_of(page):
    """Blocks of text in page order. Scripts, styles and comments are left out, character references
    decoded, and every run of white space is one blank. Unclosed elements end with the element
    around them; a tag that never ends is text, with all that follows. The time follows the length of the page."""
    found, pieces, linked, stack, count = [], [], 0, [Open("")], Counter()
    links = articles = notices = 0

    def close():
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            top = stack[-1]
            found.append(Block(text, linked, top.block, top.zone, articles, top.named))
        pieces.clear()
        linked = 0

    def add(text):
        nonlocal linked
        if text and not stack[-1].skipped:
            pieces.append(text)
            if links:
                linked += len(" ".join(text.split()))

    def pop(depth):
        for top in stack[depth:]:
            count[top.name] -= 1
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            add(page[at:])
            break
        add(page[at:start])
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            end = page.find(">", start)
            if end < 0:
                add(page[start:])
                break
            at = end + 1
            continue
        head = NAME.match(page, start)
        if head is None:
            add("<")
            at = start + 1
            continue
        end = _tag_end(page, head.end())
        if end is None:
            add(page[start:])
            break
        at, name, given = end, head[1].lower(), page[head.end() : end - 1]
        if page[start + 1] == "/":
            if name == "a":
                links = max(0, links - 1)
            if name in BLOCKS:
                close()
            if count[name]:
                depth = len(stack) - 1
                while stack[depth].name != name and (name in BLOCKS or name in SKIPPED or stack[depth].name not in BLOCKS):
                    depth -= 1
                if stack[depth].name == name:
                    pop(depth)
            continue
        if name in BLOCKS:
            close()
            links = 0 if name != "br" else links
        closed = given.rstrip().endswith("/")
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name == "a":
            links = 1
        if name in VOID or (closed and (name in FOREIGN or name not in BLOCKS)):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].name == name:
            pop(len(stack) - 1)
        said = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(given)} if given else {}
        around = stack[-1]
        own = Open(name, around.zone, name if name in BLOCKS else around.block, around.named, around.skipped or name in SKIPPED)
        notice, readers = _names(f"{said.get('class', '')} {said.get('id', '')}")
        if name in INSIDE:
            articles += 1
            if own.zone != "out":
                own.zone = "out" if readers else "in"
        elif name in OUTSIDE or "hidden" in said or said.get("aria-hidden") == "true" or ROLES.fullmatch(said.get("role") or ""):
            own.zone = "out"
        elif notice and name not in ("html", "body") and not own.named:
            notices += 1
            own.named = notices
        stack.append(own)
        count[name] += 1
    close()
    return found


def judge_names(blocks, rules):
    """Puts blocks out of the text that lie in an element named as something else, unless there is hardly any other text on
    the page."""
    size = Counter()
    for b in blocks:
        size[b.named] += len(b.text) - b.linked
    whole = sum(size.values())
    for b in blocks:
        if b.named and whole - size[b.named] >= min(rules.long, size[b.named]):
            b.zone = "out"
    return blocks


# Scripts without blanks between words: a character says about as much as three letters.
DENSE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
SENTENCE = re.compile(r"[.!?…。！？؟।]")


def classify(blocks, rules=Rules()):
    """True for each block of the main text."""
    counted, known, every = [], 0, 0
    for b in blocks:
        words = re.findall(r"\w+", b.text.lower())
        stop = sum(w in STOP_WORDS for w in words)
        counted.append((len(b.text) + 2 * len(DENSE.findall(b.text)), len(words), stop / len(words) if words else 0))
        if b.zone != "out" and 2 * b.linked < len(b.text):
            known, every = known + stop, every + len(words)
    foreign = known < rules.low / 2 * every  # the page is in none of the languages whose stop words are known
    labels = []
    for b, (length, words, stop) in zip(blocks, counted):
        share = b.linked / len(b.text)
        if b.zone == "out" or share > rules.links:
            labels.append(False)
        elif b.zone == "in":
            # an article's own text; only what is short or has few stop words waits for its neighbours
            labels.append(True if length >= rules.short and stop >= rules.low else None)
        elif length < rules.short:
            labels.append(False if not words else None)
        elif foreign:
            # length and links have to do
            labels.append((True if length >= rules.long else None) if SENTENCE.search(b.text) else False)
        elif stop >= rules.high:
            labels.append(True if length >= rules.long else None)
        elif stop >= rules.low:
            labels.append(None)
        else:
            labels.append(False)
    decided = [k for k, x in enumerate(labels) if x is not None]
    final = list(labels)
    for k, label in enumerate(labels):
        if label is not None:
            continue
        b = blocks[k]
        # neighbours count within the same article; at its edges the article itself speaks for the block
        same = lambda n: b.zone != "in" or (blocks[n].zone == "in" and blocks[n].part == b.part)
        place = bisect_left(decided, k)
        before = decided[place - 1] if place > 0 and same(decided[place - 1]) else None
        after = decided[place] if place < len(decided) and same(decided[place]) else None
        near = [labels[n] for n in (before, after) if n is not None]
        if b.zone == "in":
            final[k] = True if len(near) < 2 else any(near)
        elif b.tag in HEADINGS:
            final[k] = after is not None and labels[after]
        elif len(near) == 2 and near[0] != near[1]:
            # between text and boilerplate: a longer block with stop words is text, a scrap is not
            final[k] = len(b.text) >= rules.short
        else:
            final[k] = bool(near) and all(near)
    return final


def main_text(page, rules=Rules()):
    """The good blocks of a page, joined by blanks."""
    blocks = judge_names(blocks_of(page or ""), rules)
    return " ".join(b.text for b, good in zip(blocks, classify(blocks, rules)) if good)


def extract(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """page_id, url, text, n_chars for every row of `pages` (page_id, url, html): a NULL or empty page,
    and one without main text, has the text ''. Rows are independent: one pass, no shuffle."""

    def run(batches):
        for batch in batches:
            texts = [main_text(p, rules) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), pa.array(map(len, texts), type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html")
    kind = rows.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
