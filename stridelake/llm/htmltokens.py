"""A forgiving HTML token stream over one page."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
#: Elements whose content is text up to their own end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): kind is ``open``, ``close`` or ``text`` (name empty, rest decoded)."""
    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            yield "text", "", unescape(html[at:])
            return
        if m.start() > at:
            yield "text", "", unescape(html[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            yield "close", name, ""
            continue
        yield "open", name, m.group(3) or m.group(6) or ""
        if name in RAW:
            end = _END[name].search(html, at)
            stop = end.start() if end else n
            if name in ("textarea", "title") and stop > at:
                yield "text", "", unescape(html[at:stop])
            at = stop
            if not end:
                return


def attributes(rest: str) -> dict[str, str]:
    """Attributes of an open tag; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        out.setdefault(m.group(1).lower(), unescape(next((g for g in m.groups()[1:] if g is not None), "")))
    return out
