"""Anchors of HTML pages: a small tokeniser of tags and attributes by the rules of the HTML standard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

OPENS = re.compile(r"<(?:(!--)|([!?/])|([a-zA-Z][^\s/>]*))")
ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|(=?[^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(?!["'])([^\s>]*)))?)""")
COMMENT_ENDS = re.compile(r"--!?>")
REFERENCE = re.compile(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)(=?)")
# Elements whose content holds no tags but their own end.
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))


def _reference(found: re.Match) -> str:
    """A character reference in an attribute; an unknown name, and one without semicolon before ``=``, stand for themselves."""
    name, after = found[1], found[2]
    if name[0] != "#" and (name not in html5 or after and not name.endswith(";")):
        return found[0]
    return unescape("&" + name) + after


def attribute_text(value: str) -> str:
    """An attribute's value with its character references decoded."""
    return REFERENCE.sub(_reference, value) if "&" in value else value


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a tag (the first of a name counts) and the place behind it; -1 if the tag does not end."""
    out: dict[str, str] = {}
    while (found := ATTRIBUTE.match(html, at)) is not None:
        at = found.end()
        if found[1]:
            return out, at
        out.setdefault(found[2].lower(), found[3] or found[4] or found[5] or "")
    return out, -1


def anchor_targets(html: str) -> Iterator[str]:
    """``href`` of every anchor that has one, in document order; comments, scripts and their like hold no tags."""
    at = 0
    while (opens := OPENS.search(html, at)) is not None:
        at = opens.end()
        if opens[1]:  # ``<!-->`` and ``<!--->`` are whole comments
            ends = COMMENT_ENDS.search(html, at - 2) if html[at : at + 1] != ">" else None
            at = at + 1 if html[at : at + 1] == ">" else ends.end() if ends else len(html)
            continue
        if opens[2]:
            ends = html.find(">", at)
            at = ends + 1 if ends >= 0 else len(html)
            continue
        name = opens[3].lower()
        attributes, at = _attributes(html, at)
        if at < 0:
            return
        if name == "a" and "href" in attributes:
            yield attribute_text(attributes["href"])
        elif name in RAW:
            closes = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = closes.start() if closes else len(html)
