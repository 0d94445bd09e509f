"""Pages as sequences of leaf blocks: text, tag path, and numbers that a labeller reads."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from xxhash import xxh64_intdigest

from partysieve.llm.words import hashed

#: Elements whose text is never shown as text of the page. Raw ones run to the end of the page if nothing ends them; of the
#: others only the start tag is dropped then.
RAW = "script|style|title|textarea|iframe"
SILENT = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in (
    "template", "svg", "object", "noscript", "select", "button", "canvas", "video", "audio", "annotation", "annotation-xml")}
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
#: What an opening element closes if it is open, and the elements beyond which it closes nothing.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)""", re.S | re.I)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")

PATH, WORDS, NUMBERS = 256, 32, 8
WIDTH = PATH + WORDS + NUMBERS


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    link_share: float
    names: tuple[str, ...] = field(default=(), repr=False)


def blocks(source: str) -> list[Block]:
    """The text blocks of a page in order, white space turned into one space, character references decoded.

    Unclosed and misnested elements are closed as a browser does in simple cases: a block element ends an open
    paragraph, items and cells end the one before; an end tag without a start is passed over.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = total = 0
    in_link = False
    at, endless = 0, set()

    def flush() -> None:
        nonlocal linked, total
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, tuple(t for t, _ in stack), linked / max(1, total), tuple(n for _, ns in stack for n in ns)))
        parts.clear()
        linked = total = 0

    def close(names: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    while found := _TOKENS.match(source, at):
        at = found.end()
        text = found.group(5)
        if text is not None:
            parts.append(html.unescape(text))  # each run by itself: markup ends a reference
            total += len(text)
            linked += len(text) * in_link
            continue
        tag = found.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if tag in SILENT and not found.group(2) and not found.group(4).endswith("/") and tag not in endless:
            if end := SILENT[tag].search(source, at):
                at = end.end()
            else:
                endless.add(tag)
            continue
        if tag == "a":
            in_link = not found.group(2)
        if tag not in BLOCKS:
            if tag in ("br", "wbr", "img", "input"):
                parts.append(" ")
            continue
        flush()
        if found.group(2):
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        close({"p"}, {"div", "td", "th", "li", "article", "section", "body", "blockquote"} if tag == "p" else {"td", "th", "body"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag != "hr":
            values = " ".join("".join(m) for m in _NAMES.findall(found.group(4)))
            names = tuple(dict.fromkeys(n for n in _SPLIT.split(values.lower()) if n)) if values else ()
            stack.append((tag, names))
            in_link = False
    flush()
    return out


@lru_cache(maxsize=20_000)
def _place(path: tuple[str, ...], names: tuple[str, ...]) -> np.ndarray:
    """Signed hashes of the innermost elements and of all names."""
    out = np.zeros(PATH, np.float32)
    for name in (*path[-4:], *("." + n for n in names)):
        h = xxh64_intdigest(name)
        out[h % PATH] += 1.0 if h >> 32 & 1 else -1.0
    return np.clip(out, -3, 3)


def features(pages: list[list[Block]], start: int = 0, of: int | None = None) -> list[np.ndarray]:
    """Per page one row per block: its tag path and names, hashed words, a few numbers.

    A stretch of a page is given with the place of its first block and the number of blocks `of` the page.
    """
    flat = [b for page in pages for b in page]
    if not flat:
        return [np.zeros((0, WIDTH), np.float32) for _ in pages]
    out = np.zeros((len(flat), WIDTH), np.float32)
    out[:, :PATH] = [_place(b.path, b.names) for b in flat]
    words, bounds = hashed([b.text.encode("utf-8", "surrogatepass") for b in flat])
    n = np.diff(bounds)
    at = np.repeat(np.arange(len(flat)), n) * WORDS + (words % np.uint64(WORDS)).astype(np.int64)
    counts = np.bincount(at, minlength=len(flat) * WORDS).reshape(-1, WORDS)
    out[:, PATH:PATH + WORDS] = counts / np.sqrt((counts * counts).sum(axis=1, keepdims=True) + 1)
    sizes = np.array([len(p) for p in pages])
    place = (start + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) / (np.repeat(sizes, sizes) if of is None else of)
    out[:, PATH + WORDS:] = np.stack([
        np.log1p([len(b.text) for b in flat]) / 6, np.log1p(n) / 4, [b.link_share for b in flat],
        np.array([len(b.path) for b in flat]) / 8, place, 1 - place, [b.text[-1:] in ".!?" for b in flat], np.ones(len(flat))], axis=1)
    return np.split(out, np.cumsum(sizes)[:-1])
