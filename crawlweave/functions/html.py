"""One pass over a page's markup: title, body text, link targets, selected elements.

Follows the public HTML rules a text/link reader needs: raw-text elements, comments, character references, the
implied body, implied end tags and re-opened formatting elements. Layout repair inside tables is left out.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

# Fixed values of the HTML standard.
RAW_TEXT = {"script", "style", "xmp", "iframe", "noembed", "noframes", "noscript"}
ESCAPABLE_RAW_TEXT = {"title", "textarea"}
HEAD_TAGS = {"html", "head", "title", "style", "script", "meta", "link", "base", "basefont", "bgsound", "noframes",
             "noscript", "template"}
VOID_TAGS = {"area", "base", "basefont", "bgsound", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"}
FORMATTING = {"a", "b", "big", "code", "em", "font", "i", "nobr", "s", "small", "strike", "strong", "tt", "u"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
            "fieldset", "figcaption", "figure", "footer", "form", "header", "hgroup", "hr", "li", "listing", "main",
            "menu", "nav", "ol", "p", "plaintext", "pre", "search", "section", "summary", "table", "ul", "xmp"} | HEADINGS
# Start tag -> (elements it ends, elements that stop the search).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "a": ({"a"}, {"table", "td", "th", "button", "object", "template"}),
}
P_SCOPE = {"button", "table", "td", "th", "caption", "object", "marquee", "applet", "template", "html"}
END_SCOPE = {"table", "td", "th", "caption", "object", "marquee", "applet", "template", "html"}

BLANKS = ("\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000\ufeff")

# Runs to shorten: all but a single plain blank.
WHITESPACE = re.compile(f" [{BLANKS}]+|[{BLANKS.replace(' ', '')}][{BLANKS}]*")
_BLANK = "\t\n\x0c\r "
# After a tag name: anything up to the '>' that is not inside a quoted value.
_REST = r"""(?:[^>=]++|=[\t\n\f\r ]*+(?:"[^"]*+"|'[^']*+'|[^\t\n\f\r >"'][^\t\n\f\r >]*+|(?=>)))*+"""
_NAME = r"[A-Za-z][^\t\n\f\r />]*+"
# Comment; doctype or bogus comment; bogus end tag; tag.
_TOKEN = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/(?![A-Za-z])[^>]*(?:>|\Z)"
    rf"|(?P<end>/)?(?P<tag>{_NAME})(?P<attrs>{_REST})(?P<close>>)?)", re.S)
# Tags of a body that only separate text: all end tags, and start tags without meaning for text and links.
_MEANT = "|".join(sorted({"a", "plaintext"} | RAW_TEXT | ESCAPABLE_RAW_TEXT))
_PLAIN_TAG = rf"<(?:/|(?!(?:{_MEANT})[\t\n\f\r />])){_NAME}{_REST}>"
_RUN = re.compile(rf"(?:[^<]++|<(?![A-Za-z/!?])|{_PLAIN_TAG})*+", re.I)
_SEPARATOR = re.compile(rf"</?{_NAME}{_REST}>")
_ATTR = re.compile(
    r"""([^\t\n\f\r />=][^\t\n\f\r />=]*)(?:[\t\n\f\r ]*=[\t\n\f\r ]*(?:"([^"]*)"|'([^']*)'|([^\t\n\f\r >]*)))?""",
    re.S)
_ATTR_REFERENCE = re.compile(r"&(#[xX]?[0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)(?=(=)?)")


def _reference(match: re.Match) -> str:
    name = match[1]
    if name[0] == "#":
        return unescape(match[0])
    if name not in html5 or (match[2] and name[-1] != ";"):
        return match[0]
    return html5[name]


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag; the first of equal names counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), _ATTR_REFERENCE.sub(_reference, value) if "&" in value else value)
    return found


def decode_text(text: str) -> str:
    """Character references of a text run; a run with only ``&amp;`` needs no table."""
    marks = text.count("&")
    if not marks:
        return text
    return text.replace("&amp;", "&") if text.count("&amp;") == marks else unescape(text)


def collapse(text: str) -> str:
    return WHITESPACE.sub(" ", text).strip(" ")


class Selector:
    """``tag``, ``.class``, ``#id``, compounds of them, and descendants."""

    _COMPOUND = re.compile(r"(?:[A-Za-z][A-Za-z0-9-]*|\*)?(?:[.#][A-Za-z_-][A-Za-z0-9_-]*)*")

    def __init__(self, text: str):
        self.steps = []
        for step in text.split():
            if not self._COMPOUND.fullmatch(step):
                raise ValueError(f"unsupported selector: {text!r}")
            tag = re.match(r"[^.#*]*", step)[0].lower()
            self.steps.append((tag, set(re.findall(r"\.([^.#]+)", step)), set(re.findall(r"#([^.#]+)", step))))

    @staticmethod
    def _fits(step: tuple, element: tuple) -> bool:
        tag, classes, ids = step
        return (not tag or tag == element[0]) and classes <= element[1] and ids <= {element[2]}

    def matches(self, element: tuple, ancestors: list[tuple]) -> bool:
        if not self._fits(self.steps[-1], element):
            return False
        left = len(self.steps) - 1
        for ancestor in reversed(ancestors):
            if not left:
                break
            left -= self._fits(self.steps[left - 1], ancestor)
        return not left


def parse_selectors(text: str) -> list[Selector]:
    """A comma list of selectors; blanks are dropped, anything unknown is an error."""
    return [Selector(part.strip()) for part in text.split(",") if part.strip()]


class _Elements:
    """Open elements of a page, with the spans of text pieces and links each match covers."""

    def __init__(self, selectors: list[Selector], texts: list[str], links: list[str]):
        self.selectors, self.texts, self.links = selectors, texts, links
        self.stack: list[tuple] = []
        self.reopen: list[tuple] = []
        self.spans: list[list] = []

    def _push(self, element: tuple) -> None:
        spans = []
        for i, selector in enumerate(self.selectors):
            if selector.matches(element, self.stack):
                spans.append([i, len(self.texts), len(self.links) + (element[0] == "a" and element[3]), None, None])
        self.spans.extend(spans)
        self.stack.append((*element, spans))

    def _pop(self, upto: int, ended: str | None = None) -> None:
        while len(self.stack) > upto:
            element = self.stack.pop()
            for span in element[4]:
                span[3:] = len(self.texts), len(self.links)
            if element[0] in FORMATTING and element[0] != ended:
                self.reopen.insert(0, element[:4])

    def _end(self, names: set[str], stop: set[str], ended: str | None = None) -> bool:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                self._pop(i, ended)
                return True
            if self.stack[i][0] in stop:
                break
        return False

    def resume(self) -> None:
        """Formatting elements cut off by a block go on in the next run of text."""
        pending, self.reopen = self.reopen, []
        for element in pending:
            self._push((*element[:3], False))

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in CLOSES_P:
            self._end({"p"}, P_SCOPE)
        if tag in HEADINGS and self.stack and self.stack[-1][0] in HEADINGS:
            self._pop(len(self.stack) - 1)
        if tag in ENDS:
            self._end(*ENDS[tag], ended=tag)
        if tag not in CLOSES_P and tag not in ENDS or tag == "a":
            self.resume()
        element = (tag, set(attrs.get("class", "").split()), attrs.get("id"), "href" in attrs)
        self._push(element)
        if tag in VOID_TAGS:
            self._pop(len(self.stack) - 1, tag)

    def finish(self, tag: str) -> None:
        if not self._end(HEADINGS if tag in HEADINGS else {tag}, END_SCOPE - {tag}, ended=tag):
            self.reopen = [e for e in self.reopen if e[0] != tag]

    def chosen(self) -> tuple[list[str], list[str]]:
        self._pop(0)
        spans = sorted(self.spans, key=lambda s: s[0])
        texts = ["".join(self.texts[s[1]:s[3]]) for s in spans]
        links = [link for s in spans for link in self.links[s[2]:s[4]]]
        return [t for t in texts if t], links


def read_page(html: str, selectors: list[Selector] | None = None) -> tuple[str | None, str, list[str]]:
    """Title, cleaned text and raw link targets of a page, or of the selected elements only."""
    title = None
    texts: list[str] = []
    links: list[str] = []
    elements = _Elements(selectors, texts, links) if selectors else None
    body_from = None
    held = False
    pos, size = 0, len(html)
    while pos < size:
        if body_from is not None and not elements:
            run = _RUN.match(html, pos)
            if run.end() > pos:
                parts = _SEPARATOR.split(html[pos:run.end()])
                texts += map(decode_text, parts) if "&" in run[0] else parts
                pos = run.end()
                continue
        at = html.find("<", pos)
        token = None
        while at >= 0:
            token = _TOKEN.match(html, at)
            if token:
                break
            at = html.find("<", at + 1)
        upto = at if token else size
        if upto > pos:
            text = html[pos:upto]
            if body_from is None and not held and text.strip(_BLANK):
                body_from = len(texts)
            if elements:
                elements.resume()
            texts.append(decode_text(text))
        if not token:
            break
        pos = token.end()
        tag = token["tag"]
        if not tag:
            continue
        if not token["close"]:
            break
        tag = tag.lower()
        if token["end"]:
            if tag == "template":
                held = False
            if elements:
                elements.finish(tag)
            continue
        if body_from is None and not held:
            if tag not in HEAD_TAGS:
                body_from = len(texts)
            held = tag == "template"
        attrs = attributes(token["attrs"]) if elements or tag == "a" else {}
        if elements:
            elements.start(tag, attrs)
        if tag == "a" and "href" in attrs:
            links.append(attrs["href"])
        if tag in RAW_TEXT or tag in ESCAPABLE_RAW_TEXT or tag == "plaintext":
            end = re.compile(f"</{tag}(?=[\t\n\f\r />])", re.I).search(html, pos) if tag != "plaintext" else None
            content = html[pos:end.start() if end else size]
            pos = end.start() if end else size
            if tag in ESCAPABLE_RAW_TEXT:
                content = decode_text(content)
            if tag == "title" and title is None:
                title = content
            texts.append(content)
    title = title and title.strip(BLANKS)
    if elements:
        chunks, links = elements.chosen()
        return title or None, collapse(" ".join(chunks)), links
    return title or None, collapse("".join(texts[body_from:] if body_from is not None else [])), links
