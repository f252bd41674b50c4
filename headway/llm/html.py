"""Blocks of text of an HTML page, each with what encloses it."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# What HTML elements do to text. Content of the first group is no text at all,
# the second group breaks text into blocks, the third holds no content.
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "math", "object", "title")
_BLOCKS = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements and names (in class, id or role) of what surrounds an article.
_AROUND = frozenset("nav footer aside form button select dialog menu head".split())
_AROUND_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disclaimer footer masthead menu modal nav navbar navigation newsletter notice pagination popup promo related"
    " replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget alert"
    " complementary contentinfo copyright respond".split()
)
# Names that say where or in what form such a part stands; with one of the others they name it.
_FORMS = frozenset(
    "area article articles bar blog block body bottom box button buttons card cards container content email entry"
    " field footer form frame group head header heading icons inner inline input item items js label left link links"
    " list main mobile news outer overlay page panel policy post posts right row section site slot text thread title"
    " toggle top unit wrap wrapper".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_HIDDEN = re.compile(r"""(?i)(?:^|\s)hidden(?:\s|=|/|$)|style\s*=\s*["'][^"']*display\s*:\s*none""")
_NAME_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_END_OF_RAW = {name: re.compile(rf"(?i)</{name}(?=[\s/>]|\Z)") for name in _RAW}
_SPACES = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    inside: bool  # within an article or main element
    around: bool  # within a menu, header, footer, sidebar, notice, advert, form or comments
    article: bool  # within an article element


class _Open(NamedTuple):
    name: str
    inside: bool
    around: bool
    article: bool
    named: int  # the innermost element that a name rules out, -1 outside


def _surrounds(name: str, rest: str, inside: bool) -> bool:
    return name in _AROUND or (name == "header" and not inside) or _HIDDEN.search(rest) is not None


def _named_around(rest: str) -> bool:
    """Whether a whole name in class, id or role is one of ``_AROUND_NAMES``, alone or with
    words for place and form: 'comment-list' is, 'share-price' and 'related-work' are not."""
    for values in _NAMED.findall(rest):
        for value in "".join(values).split():
            parts = {p.lower() for p in _NAME_PARTS.findall(value)}
            if parts & _AROUND_NAMES and parts <= _AROUND_NAMES | _FORMS:
                return True
    return False


def _ruled_out(found: list[tuple[Block, int]], outer: list[int]) -> list[bool]:
    """Per element ruled out by name (``outer``: the one around it), whether it is so all the same.

    One that holds most of the page's text, where no article or main element has text outside
    such elements, is the page's body, whatever its name.
    """
    held = [0] * len(outer)
    total = apart = 0
    for block, named in found:
        if not block.around:
            total += len(block.text)
            if named >= 0:
                held[named] += len(block.text)
            elif block.inside:
                apart += len(block.text)
    for i in range(len(outer) - 1, -1, -1):
        if outer[i] >= 0:
            held[outer[i]] += held[i]
    ruled: list[bool] = []
    for i, parent in enumerate(outer):
        ruled.append(apart > 0 or 2 * held[i] <= total or (parent >= 0 and ruled[parent]))
    return ruled


def blocks(page: str) -> list[Block]:
    """Non-empty blocks in page order. A name rules out neither an outermost article or main
    element nor what holds the page's body. Character references are decoded, white space inside a
    block is one space; unclosed elements and a cut-off end are read as browsers do."""
    found: list[tuple[Block, int]] = []
    outer: list[int] = []
    text: list[str] = []
    stack = [_Open("", False, False, False, -1)]
    at = 0

    def end_block() -> None:
        if text:
            whole = _SPACES.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                found.append((Block(whole, stack[-1].inside, stack[-1].around, stack[-1].article), stack[-1].named))
            text.clear()

    while at < len(page):
        tag = page.find("<", at)
        if tag < 0:
            text.append(page[at:])
            break
        if tag > at:
            text.append(page[at:tag])
        match = _TOKEN.match(page, tag)
        if match is None:
            text.append("<")
            at = tag + 1
            continue
        at = match.end()
        name = (match["name"] or "").lower()
        if not name:
            continue
        if name in _RAW and not match["close"]:
            end_block()
            if not match["rest"].rstrip().endswith("/"):
                end = _END_OF_RAW[name].search(page, at)
                at = len(page) if end is None else end.start()
            continue
        if name in _BLOCKS:
            end_block()
        if match["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    if name not in _BLOCKS and stack[depth][2::2] != stack[depth - 1][2::2]:
                        end_block()
                    del stack[depth:]
                    break
        elif name not in _VOID:
            top = stack[-1]
            if name in ("p", "li") and top.name == name:
                stack.pop()
                top = stack[-1]
            inside = top.inside or name in ("article", "main") or "main" in _roles(match["rest"])
            around = top.around or _surrounds(name, match["rest"], inside)
            named = top.named
            body = name in ("html", "body") or (inside and not top.inside)
            if match["rest"] and not around and not body and _named_around(match["rest"]):
                outer.append(named)
                named = len(outer) - 1
            if around != top.around or named != top.named:
                end_block()
            stack.append(_Open(name, inside, around, top.article or name == "article", named))
    end_block()
    ruled = _ruled_out(found, outer)
    return [b._replace(around=b.around or (named >= 0 and ruled[named])) for b, named in found]


def _roles(rest: str) -> set[str]:
    if "role" not in rest.lower():
        return set()
    return {v.lower() for v in re.findall(r"""(?i)\brole\s*=\s*["']?([\w-]+)""", rest)}
