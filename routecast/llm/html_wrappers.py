"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tokens: tags (with their classes) and text slots. Inside
a stream, a run that repeats side by side becomes a repeated group ``(...)+``.
The distinct streams of a host are aligned one after the other; what one side
alone has becomes an optional group ``(...)?``, a repeated group takes in its
single occurrences, and texts that differ become slots. The result is the
host's wrapper. Every distinct stream is matched against it, which tells the slot of
each text. The slots are then labelled by the elements around them (article or
page furniture) and by whether their text is the same on every page, and each
page is matched again and read out through the labelled slots.
"""

from __future__ import annotations

import hashlib
import html
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.llm import store

#: Pages turned into Python strings at a time.
BATCH = 256
#: Streams that one task aligns in a row; more of a host are aligned in levels.
ALIGNED = 64
#: Repeated groups up to this length, in tokens, are looked for first; longer ones where there are none.
SHORT_GROUP = 24
#: Tokens of a wrapper beyond which its optional parts are made groups of their distinct pieces.
WIDEST = 1000
#: Mean length of texts, in characters, from which they can overrule a class word.
LONG = 80
#: Wrappers up to this size in all are sent to every task; more are joined by host.
BROADCAST_BYTES = 16 << 20

#: Element names by their meaning in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = set("nav footer aside form menu button select option textarea input head title dialog noscript iframe object canvas audio video svg template script style".split())
CONTENT = {"article", "main"}
#: Elements around the text that no class word makes furniture.
FRAME = {"html", "body", "main", "article"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Words of texts that aren't the page's own, however long they are.
ASIDE_WORDS = set("ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments disqus respond reply replies related recommended newsletter sidebar".split())
#: Words in class, id or role that name page furniture.
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe signup login comment comments disqus respond reply replies sidebar widget menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager share sharing social related recommended footer masthead topbar toolbar copyright contentinfo complementary search".split()
)
HEADER_WORDS = {"header", "banner", "masthead"}
#: Words that name what is never part of the text: readers' comments and requests for consent anywhere,
#: and inside content navigation, notices and adverts too (outside, such a word may name the frame around a whole page).
OTHERS_TEXT = set("comment comments commentlist commentform disqus respond reply replies cookie cookies cookieconsent consent gdpr".split())
NEVER_TEXT = OTHERS_TEXT | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored notice notices notification newsletter subscribe sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager".split()
)
#: With these a class says what state its element is in or what lies beside it, not what it is.
STATE_WORDS = set("has with without no is show hide active open opened closed enabled disabled".split())
#: Words that add nothing to a name.
PLAIN_WORDS = set("area box container form list section thread title wrap wrapper".split())
#: Steps of a path; below that depth only marked elements are added, each once.
DEEP = 100

#: A tag's attributes hold no ``<`` outside quotes, so a search that fails ends at the next one: reading is linear.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|title)\b(?:[^\"'<>]|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^\"'<>]|\"[^\"]*\"|'[^']*')*)>|<[!?][^<>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")


def _never_text(names: Iterable[str], never: set[str]) -> bool:
    """Whether a class, id or role says that an element is no text, whatever it holds."""
    for token in names:
        words = _WORD.findall(token)
        if never.intersection(words) and not STATE_WORDS.intersection(words):
            return True
    return False


class _Open:
    """An open element: its label, its mark, whether it is or lies in content, and the path to it.

    Marks: ``!`` furniture by its tag, hidden, or named as something that is
    never text; ``~`` furniture by another class word only (which the wrapper
    can overrule); ``*`` content.
    """

    __slots__ = ("name", "label", "mark", "content", "path", "depth")

    def __init__(self, name: str, attributes: str, around: _Open | None):
        in_content = around is not None and around.content
        named = []
        for m in _NAMES.finditer(attributes) if attributes else ():
            text = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "id":
                # Ids of headings, and of sections inside content, are made from their titles, unless they name such a thing and nothing else.
                words = set(_WORD.findall(text)) - PLAIN_WORDS
                if name in HEADINGS or (name == "section" and in_content and not (words and words <= NEVER_TEXT)):
                    continue
            named.append(text)
        words = {w for text in named for w in _WORD.findall(text)}
        hidden = bool(attributes and _HIDDEN.search(attributes))
        self.name = name
        self.label = name + "".join("." + w for w in sorted(words)) + (".-hidden" if hidden else "")
        own = name in CONTENT or "articlebody" in words
        self.content = own or in_content
        # A header inside an article is the article's own.
        header = not in_content and (name == "header" or bool(words & HEADER_WORDS))
        if name in FURNITURE or hidden or (header and name == "header") or (name not in FRAME and _never_text((t for text in named for t in text.split()), NEVER_TEXT if in_content else OTHERS_TEXT)):
            self.mark = "!"
        elif name not in FRAME and (bool(words & FURNITURE_WORDS - HEADER_WORDS) or header):
            self.mark = "~"
        else:
            self.mark = "*" if own else ""
        before, self.depth = (around.path, around.depth) if around is not None else ("", 0)
        step = self.mark + self.label
        shown = name not in INLINE or self.mark in ("!", "~")
        # Inside furniture nothing more is to be told; very deep, what is told already.
        if not shown or (before and "!" in before) or (self.depth >= DEEP and (not self.mark or f"/{step}" in before)):
            self.path = before
        else:
            self.path, self.depth = f"{before}/{step}" if before else step, self.depth + 1


def read_page(source: str) -> Iterator[tuple[str, str, str]]:
    """Tokens (kind, value, path): kinds ``open``, ``close``, ``text``, ``break`` (a block edge).

    The path of a text is that of the block elements around it, each marked
    as :class:`_Open` says. Elements that were never closed end with what holds
    them. Time is linear in the source.
    """
    stack: list[_Open] = []
    opened: Counter[str] = Counter()  # open elements by name

    def path() -> str:
        return stack[-1].path if stack else ""

    at, here = 0, ""
    for m in _TOKEN.finditer(source):
        if m.start() > at:
            yield "text", source[at : m.start()], here
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        block = name not in INLINE
        if m[2]:
            if opened[name]:
                while True:
                    e = stack.pop()
                    opened[e.name] -= 1
                    if e.name == name:
                        break
                here = path()
        else:
            if block and name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or (block and name not in VOID and opened["p"]):
                closes = {"p"} if name not in ("li", "dt", "dd", "tr", "td", "th", "option") else {name, "p"} | ({"dt", "dd"} if name in ("dt", "dd") else {"td", "th"} if name in ("td", "th", "tr") else set())
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].name in closes:
                        opened.subtract(e.name for e in stack[k:])
                        del stack[k:]
                        break
                    if stack[k].name not in INLINE:
                        break
            if name not in VOID:
                stack.append(_Open(name, m[4], stack[-1] if stack else None))
                opened[name] += 1
            here = path()
        if block:
            yield ("close" if m[2] else "open"), (stack[-1].label if not m[2] and name not in VOID else name), here
        elif name == "br":
            yield "text", " ", here
    if at < len(source):
        yield "text", source[at:], here


def parsed(source: str) -> tuple[list[str], list[tuple[str, str]], int]:
    """A page's stream, the (path, text) of each of its text tokens, and how many outermost content elements it opens outside furniture.

    The stream holds ``<label>``, ``</name>`` and ``#`` for a text, with the
    element after it where a text is furniture inside a line. Texts have their
    references decoded, white space made one space, and are trimmed; empty ones
    are left out.
    """
    out: list[str] = []
    texts: list[tuple[str, str]] = []
    parts: list[str] = []
    where, contents = "", 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            inner = where.rpartition("/")[2]
            out.append("#" + inner if inner.lstrip("!~").partition(".")[0] in INLINE else "#")
            texts.append((where, text))

    for kind, value, path in read_page(source):
        if kind == "text":
            if parts and path != where:
                flush()
            where = path
            parts.append(value)
        else:
            flush()
            out.append(f"<{value}>" if kind == "open" else f"</{value}>")
            contents += kind == "open" and path.rpartition("/")[2].startswith("*") and "!" not in path and path.count("*") == 1
    flush()
    return out, texts, contents


# ---- wrappers: nested lists; an item is a token or [sign, item, ...] with sign '+' or '?'


_REPEAT = re.compile("(.{1,%d}?)\\1+" % SHORT_GROUP, re.S)


def _repeats(items: list) -> list[tuple[int, int, int]]:
    """Runs that repeat side by side, as (start, end, length of one): short ones, or, if there are none, the shortest of any length."""
    code: dict = {}
    numbers = [code.setdefault(t, len(code)) for t in items]
    found = [(m.start(), m.end(), len(m[1])) for m in _REPEAT.finditer("".join(chr(0x100 + c) for c in numbers))]
    if found or len(items) <= 2 * SHORT_GROUP:
        return found
    s = np.array(numbers)
    for size in range(SHORT_GROUP + 1, len(s) // 2 + 1):
        # ``size`` places in a row that equal those ``size`` later include one of these.
        if not (s[size - 1 : len(s) - size : size] == s[2 * size - 1 :: size]).any():
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], s[:-size] == s[size:], [0]])))
        at = 0
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            lo = max(lo, at)
            if hi - lo >= size:
                at = lo + size * ((hi - lo) // size + 1)
                found.append((lo, at, size))
        if found:
            return found
    return found


def folded(tokens: list[str]) -> tuple[list, list[int]]:
    """The stream with repeated groups, inner ones first, and for each of its texts the number of the text token that it became."""
    items: list = list(tokens)
    count = itertools.count()
    texts: list[list[list[int]]] = [[[next(count)]] if t.startswith("#") else [] for t in tokens]
    while runs := _repeats(items):
        new, own, at = [], [], 0
        for lo, hi, size in runs:
            new += items[at:lo]
            own += texts[at:lo]
            body = items[lo : lo + size]
            body = body[0][1:] if size == 1 and isinstance(body[0], tuple) and body[0][0] == "+" else tuple(body)
            new.append(("+", *body))
            each = [[x for t in texts[p : p + size] for x in t] for p in range(lo, hi, size)]
            own.append([[k for x in same for k in x] for same in zip(*each)])
            at = hi
        items, texts = new + items[at:], own + texts[at:]
    became = [0] * next(count)
    for number, same in enumerate(x for t in texts for x in t):
        for k in same:
            became[k] = number
    return _lists(items), became


def _lists(items) -> list:
    return [x if isinstance(x, str) else _lists(x) for x in items]


def grouped(tokens: list[str]) -> list:
    """Runs that repeat side by side become one repeated group, inner ones first."""
    return folded(tokens)[0]


def _key(item) -> str:
    if isinstance(item, str):
        return item
    return f"({_key(item[1])}){item[0]}"


def _bare(items: list) -> list:
    """The items as one occurrence of everything, for comparisons."""
    return [x for i in items for x in (_bare(i[1:]) if isinstance(i, list) else [i])]


def _opened(items: list, run: tuple = ()) -> list[tuple]:
    """The items with optional groups opened: (item, the optional groups it was in)."""
    out = []
    for k, x in enumerate(items):
        if isinstance(x, list) and x[0] == "?":
            out += _opened(x[1:], (*run, k))
        else:
            out.append((x, run))
    return out


def _closed(opened: Iterable[tuple]) -> list:
    """Neighbours of the same optional group are one group again."""
    out: list = []
    for run, same in itertools.groupby(opened, key=lambda x: x[1]):
        items = [x for x, _ in same]
        out += [["?", *items]] if run else items
    return out


def aligned(a: list, b: list) -> list:
    """One wrapper for both: equal items stay, a repeated group takes in its occurrences, the rest becomes optional.

    It has every stream of either side. Optional groups are opened first, so
    what an earlier page lacked still meets its like in the next one.
    """
    out: list[tuple] = []
    left, right = _opened(a), _opened(b)
    for op, i, j, p, q in SequenceMatcher(None, [_key(x) for x, _ in left], [_key(x) for x, _ in right], autojunk=False).get_opcodes():
        if op == "equal":
            for (x, r), (y, t) in zip(left[i:j], right[p:q]):
                out.append((x if x == y else [x[0], *aligned(x[1:], y[1:])], ("=", r, t) if r or t else ()))
            continue
        sides = left[i:j], right[p:q]
        bare = [_bare([x for x, _ in side]) for side in sides]
        for one, other in (sides, sides[::-1]):
            # A group on one side against its own body, once, on the other.
            if len(one) == 1 and isinstance(one[0][0], list) and bare[0] == bare[1]:
                out.append((["+", *aligned(one[0][0][1:], _closed(other))], ("+", i, p) if any(r for _, r in one + other) else ()))
                break
        else:
            for n, run in enumerate(sides):
                # What the wrapper has just repeated is another occurrence of it.
                if run and out and isinstance(out[-1][0], list) and _bare([out[-1][0]]) == bare[n]:
                    out[-1] = (["+", *aligned(out[-1][0][1:], _closed(run))], ("+", i, p, n) if out[-1][1] else ())
                else:
                    out += [(x, (n, i, p, r)) for x, r in run]
    return _closed(out)


def _pieces(items: list) -> list[tuple]:
    """Runs of tokens that always occur whole, cut before each opening tag."""
    out: list[tuple] = []
    for is_group, run in itertools.groupby(items, key=lambda x: isinstance(x, list)):
        for x in run:
            if is_group:
                out += _pieces(x[1:])
            elif out and out[-1] and not (x[0] == "<" and x[1] != "/"):
                out[-1] = (*out[-1], x)
            else:
                out.append((x,))
        out.append(())
    return [x for x in dict.fromkeys(out) if x]


def narrowed(wrapper: list) -> list:
    """A wrapper of more than ``WIDEST`` tokens with what lies between two tokens that every page has made one group of its distinct pieces.

    The group ``((piece)?(piece)?...)+`` has its pieces in any order, so it has
    all that was there before: hosts whose pages all differ get a wider
    wrapper, not an ever longer one.
    """
    if len(_bare(wrapper)) <= WIDEST:
        return wrapper
    out: list = []
    for is_group, run in itertools.groupby(wrapper, key=lambda x: isinstance(x, list)):
        items = list(run)
        pieces = _pieces(items) if is_group else []
        short = is_group and sum(map(len, pieces)) < len(_bare(items))
        out += [["?", ["+", *(["?", *x] for x in pieces)]]] if short else items
    return out


def as_text(wrapper: list) -> str:
    """The wrapper as a regular expression over tokens."""
    return "".join(x if isinstance(x, str) else f"({as_text(x[1:])}){x[0]}" for x in wrapper)


class Matcher:
    """Finds the place in a wrapper of every token of a stream.

    Places are the tokens of the wrapper in their order; ``after[p]`` says for
    each token which places can follow place p (-1 is the start). All ways
    through the wrapper are followed at once, so time is linear in the stream.
    """

    def __init__(self, wrapper: list):
        self.tokens = _bare(wrapper)
        self.after: list[dict[str, dict[int, None]]] = [{} for _ in range(len(self.tokens) + 1)]
        self.count = itertools.count()
        first, last, empty = self._sequence(wrapper)
        self._link([-1], first)
        self.ends = set(last) | ({-1} if empty else set())

    def _link(self, last: Iterable[int], first: Iterable[int]) -> None:
        for p in last:
            for q in first:
                self.after[p].setdefault(self.tokens[q], {})[q] = None

    def _sequence(self, items: list) -> tuple[list[int], list[int], bool]:
        """The places a sequence can begin and end with, and whether it can be empty."""
        first, last, empty = [], [], True
        for item in items:
            if isinstance(item, str):
                f = t = [next(self.count)]
                e = False
            else:
                f, t, e = self._sequence(item[1:])
                if item[0] == "+":
                    self._link(t, f)
                else:
                    e = True
            self._link(last, f)
            first = first + f if empty else first
            last = last + t if e else t
            empty = empty and e
        return first, last, empty

    def places(self, tokens: list[str]) -> list[int] | None:
        """The place of each token; None if the wrapper doesn't have the stream."""
        steps: list[dict[int, int]] = []
        here: Iterable[int] = (-1,)
        for t in tokens:
            step: dict[int, int] = {}
            for p in here:
                for q in self.after[p].get(t, ()):
                    step.setdefault(q, p)
            if not step:
                return None
            steps.append(step)
            here = step
        end = min((p for p in here if p in self.ends), default=None)
        if end is None:
            return None
        out = []
        for step in reversed(steps):
            out.append(end)
            end = step[end]
        return out[::-1]

    def slots(self, folded_stream: list) -> list[int] | None:
        """The place of each text token of a folded stream, each group taken once."""
        tokens = _bare(folded_stream)
        places = self.places(tokens)
        return None if places is None else [p for p, t in zip(places, tokens) if t.startswith("#")]


def _pages(batch: pa.RecordBatch, host: int, source: int) -> Iterator[tuple[str, str | None]]:
    for lo in range(0, batch.num_rows, BATCH):
        part = batch.slice(lo, BATCH)
        yield from zip(part.column(host).to_pylist(), part.column(source).to_pylist())


#: Of a slot: pages, lowest and highest digest of its text, characters, texts, and characters on pages with content elements.
_COUNTS = ("n", "low", "high", "chars", "texts", "beside")


def _digest(value: str) -> str:
    return hashlib.blake2b(value.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _text_digest(text: str, before: int) -> int:
    """64 bits of a slot's texts so far."""
    h = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8, salt=before.to_bytes(8, "little", signed=True))
    return int.from_bytes(h.digest(), "little", signed=True)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """One row per host: ``host``, ``wrapper`` (regular expression), ``expression`` (the same as JSON), ``n_pages``, ``contents``, ``marked`` and ``slots``.

    ``slots``: array of (slot, path, n_pages, constant, chars, texts, beside): each text
    slot by its place in the wrapper and the elements around it there, how many
    pages fill it, whether every page that does fills it with the same text, and
    how many characters and texts it has on all pages, and characters on those
    with content elements. ``contents``: outermost content elements on all
    pages; ``marked``: pages that have any.

    A host's pages are reduced to their distinct streams and to a row for each
    text token of these before anything is shuffled, so a host with a third of
    all pages costs no more than its distinct streams; those are aligned
    ``ALIGNED`` at a time in as many levels as it takes, and each is then
    matched against the wrapper.
    """

    store.small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[str, str, int, str], list[int]] = {}
            for host, source in _pages(batch, 0, 1):
                tokens, texts, contents = parsed(source or "")
                whole, became = folded(tokens)
                value = json.dumps(whole)
                name = _digest(value)
                own: dict[tuple[str, str, int, str], list[int]] = {(host, name, -1, value): [0, contents, 0, int(contents > 0)]}
                for slot, (path, text) in zip(became, texts):
                    at = own.setdefault((host, name, slot, path), [0, 0, 0, 0])
                    at[0], at[1], at[2] = _text_digest(text, at[0]), at[1] + len(text), at[2] + 1
                    at[3] += len(text) if contents else 0
                for k, (h, chars, n_texts, beside) in own.items():
                    n = seen.setdefault(k, [0, h, h, 0, 0, 0])
                    n[0], n[1], n[2], n[3], n[4], n[5] = n[0] + 1, min(n[1], h), max(n[2], h), n[3] + chars, n[4] + n_texts, n[5] + beside
            rows = [(*k, *v) for k, v in seen.items()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 10, kinds)], names=["host", "stream", "slot", "value", *_COUNTS])

    rows = pages.select(_host(F.col(url)).alias("host"), F.col(page).cast("string").alias("html"))
    counts = "n long, low long, high long, chars long, texts long, beside long"
    found = rows.mapInArrow(run, f"host string, stream string, slot long, value string, {counts}")
    totals = [(F.min if c == "low" else F.max if c == "high" else F.sum)(c).alias(c) for c in _COUNTS]
    found = store.written(found.groupBy("host", "stream", "slot", "value").agg(*totals), "streams")

    def align(group: tuple, rows: pa.Table) -> pa.Table:
        n = rows["n"].to_pylist()
        ordered = sorted(zip(n, rows["value"].to_pylist()), key=lambda x: (-x[0], x[1]))
        whole = json.loads(ordered[0][1])
        for _, value in ordered[1:]:
            whole = narrowed(aligned(whole, json.loads(value)))
        return pa.table({"host": [group[0].as_py()], "value": [json.dumps(whole)], "n": pa.array([sum(n)], pa.int64()), "wrapper": [as_text(whole)]})

    level = found.where("slot < 0").select("host", "value", "n")
    while True:
        per_host = level.groupBy("host").agg(F.count("*").alias("streams"))
        most = per_host.agg(F.max("streams")).first()[0] or 0
        parts = F.ceil(F.col("streams") / ALIGNED)
        dealt = level.join(per_host, "host").withColumn("part", F.pmod(F.xxhash64("value"), parts))
        level = store.written(dealt.groupBy("host", "part").applyInArrow(align, "host string, value string, n long, wrapper string"), "aligned")
        if most <= ALIGNED:
            break

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, matcher = None, None
        for batch in batches:
            out = []
            for host, value, slots, expression in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (host, expression) != last:
                    last, matcher = (host, expression), Matcher(json.loads(expression))
                places = matcher.slots(json.loads(value))
                out += [(host, places[s["slot"]], s["value"], *(s[c] for c in _COUNTS)) for s in slots or () if places]
            kinds = (pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 6)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 9, kinds)], names=["host", "slot", "path", *_COUNTS])

    wrappers = level.select("host", "wrapper", F.col("value").alias("expression"), F.col("n").alias("n_pages"))
    text = F.when(F.col("slot") >= 0, F.struct("slot", "value", *_COUNTS))
    streams = found.groupBy("host", "stream").agg(F.max(F.when(F.col("slot") < 0, F.col("value"))).alias("value"), F.collect_list(text).alias("texts"))
    n_bytes = level.agg(F.sum(F.length("value") + F.length("host"))).first()[0] or 0
    small = wrappers.select("host", "expression")
    small = F.broadcast(small) if n_bytes <= BROADCAST_BYTES else small
    placed = streams.join(small, "host").select("host", "value", "texts", "expression").mapInArrow(match, f"host string, slot long, path string, {counts}")
    slot = placed.groupBy("host", "slot", "path").agg(*totals)
    named = F.struct("slot", "path", F.col("n").alias("n_pages"), (F.col("low") == F.col("high")).alias("constant"), "chars", "texts", "beside")
    slots = slot.groupBy("host").agg(F.array_sort(F.collect_list(named)).alias("slots"))
    contents = found.where("slot < 0").groupBy("host").agg(F.sum("chars").alias("contents"), F.sum("beside").alias("marked"))
    return store.written(wrappers.join(contents, "host").join(slots, "host", "left"), "wrappers")


def overruled(slots: list[dict], varying: set[tuple[int, str]]) -> set[str]:
    """The elements that are furniture by a class word but hold main text by what the host's pages show.

    Inside content these are elements with long varying texts, unless the word
    names texts of others (comments, ads). Elsewhere they have to hold more
    varying text than all that isn't furniture, and long texts too. Of nested
    ones the outer is judged first, by the slots that have no other mark.
    """
    out: set[str] = set()
    while True:
        plain, own = 0, {}
        for s in slots:
            steps = s["path"].split("/")
            weak = [x for x in steps if x[:1] == "~" and x not in out]
            if (s["slot"], s["path"]) not in varying or "!" in s["path"]:
                continue
            if not weak:
                plain += s["chars"]
            elif len(set(weak)) == 1:
                inside = any(x[:1] == "*" for x in steps[: steps.index(weak[0])])
                at = own.setdefault(weak[0], [0, 0, True])
                at[0], at[1], at[2] = at[0] + s["chars"], at[1] + s["texts"], at[2] and inside
        long = {x: chars for x, (chars, texts, _) in own.items() if chars >= LONG * texts}
        new = {x for x in long if own[x][2] and not ASIDE_WORDS & set(x.split(".")[1:])}
        # One at a time of the others: what it holds counts against the next.
        new = new or set(sorted((x for x in long if long[x] > plain), key=lambda x: (-long[x], x))[:1])
        if not new:
            return out
        out |= new


Slots = set[tuple[int, str]]


def kept_slots(slots: list[dict], n_pages: int, contents: int, marked: int) -> tuple[Slots, Slots]:
    """The slots that hold main text, as two sets: a page is read through the first that it fills.

    Furniture never does. One set are the slots inside content elements, the
    other those outside whose text is not the same on all of the host's pages;
    where nothing varies, because all rows are copies of one page or differ in
    furniture only, nothing shows a template and all of those outside stay.
    Content goes first, unless the host's pages with content elements have more
    text outside, in long texts, than in one of these: they are teasers then.
    """
    varying = {(s["slot"], s["path"]) for s in slots if not (s["constant"] and n_pages > 1 and s["n_pages"] == n_pages)}
    if not any("!" not in path for _, path in varying):
        varying = {(s["slot"], s["path"]) for s in slots}
    words = overruled(slots, varying)
    plain = [s for s in slots if not any(x[:1] == "!" or (x[:1] == "~" and x not in words) for x in s["path"].split("/"))]
    inside = [s for s in plain if "*" in s["path"]]
    outside = [s for s in plain if "*" not in s["path"]]
    if any((s["slot"], s["path"]) in varying for s in plain):
        outside = [s for s in outside if (s["slot"], s["path"]) in varying]
    beside = sum(s["beside"] for s in outside)
    long = sum(s["chars"] - LONG * s["texts"] for s in outside if s["beside"]) >= 0
    teasers = long and beside * contents > sum(s["chars"] for s in inside) * marked
    sets = [{(s["slot"], s["path"]) for s in part} for part in (inside, outside)]
    return (sets[1], sets[0]) if teasers else (sets[0], sets[1])


class _Reader:
    """A host's matcher and kept slots."""

    def __init__(self, expression: str | None, slots: list[dict] | None, n_pages: int | None, contents: int | None, marked: int | None):
        self.matcher = Matcher(json.loads(expression)) if expression is not None else None
        self.kept = kept_slots(slots or [], n_pages or 0, contents or 0, marked or 0)
        self.known: dict[str, list[int] | None] = {}

    def text(self, source: str) -> str:
        tokens, texts, contents = parsed(source)
        whole, became = folded(tokens)
        value = json.dumps(whole)
        if value not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            self.known[value] = self.matcher.slots(whole) if self.matcher else None
        places, kept = self.known[value], self.kept
        if places is None:
            # Not a page of the wrapper's host: judged by itself.
            places = list(range(len(became)))
            alone = [{"slot": k, "path": p, "n_pages": 1, "constant": True, "chars": len(t), "texts": 1, "beside": len(t) if contents else 0} for k, (p, t) in zip(became, texts)]
            kept = kept_slots(alone, 1, contents, int(contents > 0))
        for slots in kept:
            if found := [t for k, (path, t) in zip(became, texts) if (places[k], path) in slots]:
                return "\n".join(found)
        return ""


def extract_text(pages: DataFrame, wrappers: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), url: str = "url", page: str = "html") -> DataFrame:
    """``keys`` and ``text`` of every page, read through its host's wrapper.

    Blocks are joined in page order by one line feed; a page without main text,
    an empty or a null html gives an empty string. Null urls share one wrapper.
    Equal keys and repeated pages keep a row each, and copies of one page alone
    don't make its text a template. An empty table gives no
    rows. Other columns are left out.
    """
    small = wrappers.select("host", "expression", "slots", "n_pages", "contents", "marked")
    n_bytes = wrappers.agg(F.sum(F.length(F.to_json("slots")) + F.length("host") + F.length("expression"))).first()[0] or 0
    small = F.broadcast(small) if n_bytes <= BROADCAST_BYTES else small
    own = pages.select(F.struct(*keys).alias("keys"), _host(F.col(url)).alias("host"), F.col(page).cast("string").alias("html"))
    joined = own.join(small, "host", "left").select("keys", "host", "html", "expression", "slots", "n_pages", "contents", "marked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Reader] = {}
        for batch in batches:
            out = []
            for k, (host, source) in enumerate(_pages(batch, 1, 2)):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = _Reader(*(batch.column(i)[k].as_py() for i in range(3, 8)))
                out.append(known[host].text(source or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["keys", "text"])

    schema = own.select("keys").schema.add("text", "string")
    return joined.mapInArrow(run, schema).select("keys.*", "text")
