"""A small DOM for HTML pages: a lenient tokenizer, implied end tags, and blocks of text."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from dataclasses import dataclass, field

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
#: An opening tag ends an open element of these names, up to the nearest of the scopes.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table select html body article section div".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass
class Node:
    tag: str
    attributes: str = ""
    children: list[Node | str] = field(default_factory=list)

    def attribute(self, name: str) -> str | None:
        if not self.attributes:
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return references.unescape(m[2] or m[3] or m[4] or "")
        return None

    def names(self) -> list[str]:
        """Class, id and role tokens, lower-cased."""
        if not self.attributes:
            return []
        return " ".join(v for n in ("class", "id", "role") if (v := self.attribute(n))).lower().split()


def parse(page: str) -> Node:
    """The page's tree; any text gives one."""
    root = Node("#root")
    stack, at, n = [root], 0, len(page)
    open_: Counter[str] = Counter()  # elements on the stack, by tag

    def close(i: int) -> None:
        """Ends the elements from the i-th on."""
        open_.subtract(x.tag for x in stack[i:])
        del stack[i:]

    def text(a: int, b: int) -> None:
        if a < b:
            stack[-1].children.append(page[a:b])

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(m.start() + 9, m.end() - 3 if m[0].endswith("]]>") else m.end())
            continue
        tag = tag.lower()
        if m[1]:
            for i in () if not open_[tag] else range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                # an end tag of an inline element doesn't close the block around it
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if tag in ENDS_P and open_["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in CLOSES.get(tag, ()):
                close(i)
            elif stack[i].tag in SCOPES or tag not in CLOSES:
                break
        node = Node(tag, m[3].strip())
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in INLINE | ENDS_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            stop = end.start() if end else n
            if stop > at:
                node.children.append(page[at:stop])
            at = end.end() if end else n
            continue
        stack.append(node)
        open_[tag] += 1
    return root


def squeezed(text: str) -> str:
    """References decoded, white space runs turned into one space, trimmed."""
    return " ".join(references.unescape(text).split())
