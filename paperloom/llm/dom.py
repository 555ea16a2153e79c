"""A page's elements and text runs as one tree, in page order."""

import html
import re

#: Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
RAW = set("script style textarea title xmp iframe noembed noframes".split())
#: An opening tag on the left closes an open one on the right, up to the nearest of the last.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z) | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    | <(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z) | [^<]+ | <""",
    re.S | re.X,
)
_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
_NAMED = re.compile(r"""\b(class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[a-z0-9]+")
#: Words that make the next word of a name a state of the element, as in has-sidebar.
STATE_WORDS = set("has no non not overflow with without".split())


class Tree:
    """Parents come before children. Text runs are leaves named #text.

    `linked` counts the characters of a run that stand in links.
    """

    def __init__(self):
        self.parent, self.name, self.marks, self.text, self.linked = [], [], [], [], []

    def add(self, parent, name, marks=()):
        self.parent.append(parent)
        self.name.append(name)
        self.marks.append(marks)
        self.text.append("")
        self.linked.append(0)
        return len(self.name) - 1


def _marks(attributes):
    """The tokens of class, id and role, and whole labels, as words."""
    found = set()
    for kind, *values in _NAMED.findall(attributes) if "=" in attributes else ():
        value = "".join(values).lower()
        for token in [value] if kind.lower() == "aria-label" else value.split():
            found.add(" ".join(_PART.findall(token)))
    return tuple(sorted(found - {""}))


def parse(page):
    """The tree of a page; inline elements belong to their block's text run."""
    tree = Tree()
    open_nodes = [(tree.add(-1, "#page"), "#page")]  # node or None for inline elements, name
    pieces, in_link = [], 0

    def block():
        return next(node for node, _ in reversed(open_nodes) if node is not None)

    def flush():
        if pieces:
            words = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if words:
                node = tree.add(block(), "#text")
                tree.text[node] = words
                tree.linked[node] = sum(len(p) for p, link in pieces if link)
            pieces.clear()

    def close_to(depth):
        nonlocal in_link
        if any(node is not None for node, _ in open_nodes[depth:]):
            flush()
        del open_nodes[depth:]
        in_link = sum(name == "a" for _, name in open_nodes)

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            if token[0][0] != "<" or len(token[0]) == 1:
                pieces.append((token[0], in_link))
            continue
        name, closing = name.lower(), bool(token[1] or token[4])
        if closing:
            for depth in range(len(open_nodes) - 1, 0, -1):
                node, other = open_nodes[depth]
                if other == name:
                    close_to(depth)
                    break
                if node is not None and name in INLINE:
                    break
            continue
        if name in INLINE:
            if name in VOID:
                pieces.append((" ", in_link))
            else:
                open_nodes.append((None, name))
                in_link += name == "a"
            continue
        flush()
        for depth in range(len(open_nodes) - 1, 0, -1):  # an open paragraph ends
            node, other = open_nodes[depth]
            if other == "p":
                close_to(depth)
            if node is not None:
                break
        ended, within = CLOSES.get(name, ((), ()))
        for depth in range(len(open_nodes) - 1, 0, -1):
            other = open_nodes[depth][1]
            if other in within:
                break
            if other in ended:
                close_to(depth)
                if name != "tr":
                    break
        node = tree.add(block(), name, _marks(token[3] or token[6] or ""))
        if name in RAW:
            end = _END[name].search(page, at)
            at = end.start() if end else size
            if end:
                closed = page.find(">", at)
                at = size if closed < 0 else closed + 1
        elif name not in VOID:
            open_nodes.append((node, name))
    flush()
    return tree
