"""HTML extraction: a tree-structured graphical model over the DOM.

Every element and text run is a node in one of three states: frame (page structure),
content, excluded. Parent-child potentials connect nodes; the features of a node (the
name of an element and the words of its class, id and role; the length, links, end and
parent of a text run) give its own potential. Sum-product messages pass upward and then downward,
which gives every node's marginals in two visits; the text runs that are most likely
content are the page's text, in page order.

The model is trained by counting over labelled pages: pages that name their article
themselves. There, the article and what is below it are content, and known side parts
with all below them are excluded. Of these, `SAMPLE` pages with the lowest id hash are the
labelled sample; counts of features and of parent-child states are summed by Spark, and the tables
of these counts are the only thing the driver receives.

Elements that never hold text of their own (`CLAMPED`) are observed as excluded; nothing else
is. Names and marks of side parts are evidence of three strengths (`KINDS`): names such as
nav and footer; class, id, role and label words whose whole token is a known mark; and tokens
that only hold one, or one that wraps articles as well. How likely such an element is a side
part depends on its kind, on its own share of the page's text and on the share that stands
outside all such elements: a comment section beside an article is one, the same mark around
the whole text is not. That table has a prior and is counted on labelled pages, where the
element holds the article or stands outside it. The table decides between excluded and not,
given the parent's state; what the element holds then decides between frame and content.
The page's text is here what stands in article or main elements, on pages without them all of
it, links aside.

Defined results: character references are decoded, white space inside a block becomes one
space, blocks are joined by one line feed; a null or empty page and a page without
content have the empty text; broken markup is read to its end; repeated rows are read
alike; an empty table gives an empty table; without labelled pages the potentials are the
smoothing and the prior alone, and only what a page names its article is content.
"""

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm.dom import STATE_WORDS, parse
from paperloom.llm.runtime import ship

SAMPLE = 4096
FRAME, CONTENT, EXCLUDED = 0, 1, 2
STATES = (FRAME, CONTENT, EXCLUDED)
SMOOTHING, FLOOR = 0.5, -4.0
#: added to the counts of states below a state: what is excluded stays so, content mostly does
EDGE_SMOOTHING = ((1.0, 1.0, 1.0), (1e-3, 50.0, 1.0), (1e-12, 1e-12, 1.0))

#: Elements whose text is never the page's.
CLAMPED = set(
    "button head iframe input legend link meta noembed noframes noscript object option script select style svg template"
    " textarea title".split()
)
#: Names of elements, and words in class, id, role and label, that mark side parts.
SIDE_NAMES = set("aside dialog footer header menu nav".split())
FORM_NAMES = set("form fieldset".split())
SIDE_MARKS = set(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs captcha comment comments consent"
    " contentinfo cookie cookies copyright dialog disqus footer gdpr hidden login masthead menu modal nav navbar"
    " navigation newsletter notice notices outbrain overlay pagination paywall popup promo promoted promotion"
    " reactions recommended related replies respond search share sharing sidebar signup skip social sponsor"
    " sponsored subscribe subscription taboola toolbar tooltip widget widgets".split()
)
#: Marks that wrap articles as often.
LOOSE_MARKS = set("banner hidden notice notices overlay related search widget widgets".split())
KINDS = NAME, WHOLE, PART = "name", "whole", "part"
_TOKENS = 20.0


def _prior(kind, free, own):
    """How likely an element of the kind is a side part, before any page is seen.

    `free`: 0, 1 or 2 for less than an eighth, less than half, more of the text outside
    marked elements; `own`: 0, 1, 2 or 3 for less than an eighth, a third, half, more of it
    in the element.
    """
    if kind == NAME:
        return 0.98
    if kind == WHOLE:
        return 0.05 if free == 0 and own == 3 else 0.97
    return 0.05 if free == 0 else ((0.7, 0.3, 0.2, 0.1), (0.9, 0.6, 0.2, 0.1))[free - 1][own]


OWN_NAMES = ("article", "main")
#: Every page with such an element has this, a few others too.
NAMED = f"(?i)<({'|'.join(OWN_NAMES)})"
#: Elements that stand in articles and side parts alike; their names tell nothing.
NEUTRAL = set("caption center dd details div dl dt figcaption figure li ol section summary table tbody td tfoot th thead tr ul".split())


def kind_of(tree, node):
    """The strength of a node's marks; None without one."""
    name = tree.name[node]
    if name in SIDE_NAMES:
        return NAME
    if name in FORM_NAMES:
        return WHOLE
    if name in (*OWN_NAMES, "body", "html", "#page", "#text"):
        return None
    tokens = [token.split() for token in tree.marks[node]]
    if any(SIDE_MARKS.issuperset(token) and not LOOSE_MARKS.issuperset(token) for token in tokens):
        return WHOLE
    words = {word for token in tokens for before, word in zip(["", *token], token) if before not in STATE_WORDS}
    return PART if words & SIDE_MARKS else None


def _level(share, *bounds):
    return sum(share >= bound for bound in bounds)


def evidence(tree, table=None):
    """Of every node: None, or its cell (kind, free, own) and how likely it is a side part.

    Read from the top: an element that is rather no side part frees the text it holds.
    """
    size = len(tree.parent)
    found = [None] * size
    kinds = [kind_of(tree, node) for node in range(size)]
    if not any(kinds):
        return found
    clamped = [name in CLAMPED for name in tree.name]
    inside, near = [False] * size, [-1] * size  # below an article or main; the nearest marked element
    for node in range(size):
        parent = tree.parent[node]
        if parent >= 0:
            clamped[node] = clamped[node] or clamped[parent]
            inside[node], near[node] = inside[parent], near[parent]
        inside[node] = inside[node] or (tree.name[node] in OWN_NAMES and not clamped[node])
        near[node] = node if kinds[node] else near[node]
    named = any(inside)
    weight, direct = [0] * size, Counter()
    for node in range(size - 1, -1, -1):
        if tree.text[node] and not clamped[node] and (inside[node] or not named):
            weight[node] = max(len(tree.text[node]) - tree.linked[node], 0)
            direct[near[node]] += weight[node]
        if node:
            weight[tree.parent[node]] += weight[node]
    free, whole, gone = direct[-1], weight[0], [False] * size
    for node in range(1, size):
        gone[node] = gone[tree.parent[node]]
        if kinds[node] is None or clamped[node] or gone[node]:
            continue
        free_share = free / whole if whole else 1.0
        own_share = weight[node] / whole if whole else 0.0
        cell = (kinds[node], _level(free_share, 1 / 8, 1 / 2), _level(own_share, 1 / 8, 1 / 3, 1 / 2))
        odds = (table or {}).get(cell, _prior(*cell))
        found[node] = (cell, odds)
        gone[node] = odds > 0.5
        if not gone[node]:
            free += direct[node]
    return found


def _features(tree, node):
    parent = tree.parent[node]
    above = tree.name[parent] if parent >= 0 else ""
    name = tree.name[node]
    if name != "#text":
        told = [f"name {name}"] if name not in NEUTRAL else []
        return [*told, *[f"mark {word}" for word in sorted({w for mark in tree.marks[node] for w in mark.split()})]]
    text = tree.text[node]
    length, share = len(text), tree.linked[node] / len(text)
    told = [f"text below {above}"] if above not in NEUTRAL else []
    return [
        *told,
        f"length {min(int(math.log2(length + 1)) // 2, 5)}",
        f"links {min(int(4 * share), 4)}",
        f"sentence {text[-1] in '.!?…\"”'} {' ' in text}",
    ]


def labelled(tree):
    """The states of a page that names its article; None for other pages."""
    if not any(name in OWN_NAMES for name in tree.name):
        return None
    states, marks = [], evidence(tree)
    for node, parent in enumerate(tree.parent):
        above = states[parent] if parent >= 0 else FRAME
        if above == EXCLUDED or tree.name[node] in CLAMPED or (marks[node] and marks[node][1] > 0.5):
            states.append(EXCLUDED)
        elif above == CONTENT or tree.name[node] in OWN_NAMES:
            states.append(CONTENT)
        else:
            states.append(FRAME)
    return states


def _marked_cells(tree, marks):
    """Cells of marked elements that hold an article, or stand outside, where that is known."""
    holds, below = set(), set()
    for node, name in enumerate(tree.name):
        if name in OWN_NAMES or tree.parent[node] in below:
            below.add(node)
    for node in below:
        while (node := tree.parent[node]) >= 0 and node not in holds:
            holds.add(node)
    for node, mark in enumerate(marks):
        if mark and node not in below:
            yield mark[0], FRAME if node in holds else EXCLUDED


def _counts(batches):
    """(kind, key, state, n): features by state, states by the parent's state, and marked cells."""
    for batch in batches:
        found = Counter()
        for page in batch.column(0):
            tree = parse(page.as_py() or "")
            states = labelled(tree)
            marks = evidence(tree) if states else ()
            for cell, state in _marked_cells(tree, marks):
                found["cell", " ".join(map(str, cell)), state] += 1
            for node, state in enumerate(states or ()):
                if marks[node] or tree.name[node] in CLAMPED:
                    continue
                found["state", "", state] += 1
                if tree.parent[node] >= 0:
                    found["edge", str(states[tree.parent[node]]), state] += 1
                for feature in _features(tree, node):
                    found["feature", feature, state] += 1
        kinds, keys, states = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(kinds, pa.string()),
                pa.array(keys, pa.string()),
                pa.array(states, pa.int32()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["kind", "key", "state", "n"],
        )


class Model:
    """Potentials from counts."""

    def __init__(self, counts):
        """counts: {(kind, key, state): n}."""
        total = [counts.get(("state", "", s), 0) + 3 * SMOOTHING for s in STATES]
        self.edge = []
        for above in STATES:
            row = [counts.get(("edge", str(above), s), 0) + EDGE_SMOOTHING[above][s] for s in STATES]
            self.edge.append([n / sum(row) for n in row])
        self.feature = {}
        for key in {key for kind, key, _ in counts if kind == "feature"}:
            seen = [counts.get(("feature", key, s), 0) for s in STATES]
            self.feature[key] = [math.log((n + SMOOTHING) / t) for n, t in zip(seen, total)]
        self.side = {}
        for kind in KINDS:
            for cell in ((kind, free, own) for free in range(3) for own in range(4)):
                kept, gone = (counts.get(("cell", " ".join(map(str, cell)), s), 0) for s in (FRAME, EXCLUDED))
                self.side[cell] = (gone + _TOKENS * _prior(*cell)) / (kept + gone + _TOKENS)

    def own(self, tree, node):
        """The node's own potential."""
        if tree.name[node] in CLAMPED:
            return [0.0, 0.0, 1.0]
        if tree.parent[node] < 0:
            return [1.0, 0.0, 0.0]
        if tree.name[node] in OWN_NAMES:
            return [math.exp(FLOOR), 1.0, math.exp(FLOOR)]
        sums = [0.0, 0.0, 0.0]
        for feature in _features(tree, node):
            known = self.feature.get(feature)
            if known:
                sums = [a + b for a, b in zip(sums, known)]
        most = max(sums)
        return [math.exp(max(s - most, FLOOR)) for s in sums]

    def steps(self, side):
        """Potentials of (parent's state, state) of a marked element."""
        found = []
        for above, (frame, content, _) in zip(STATES, self.edge):
            kept = (1 - side) / (frame + content)
            found.append([frame * kept, content * kept, side] if above != EXCLUDED else self.edge[above])
        return found

    def marginals(self, tree):
        """The states' probabilities at every node."""
        size = len(tree.parent)
        marks = evidence(tree, self.side)
        belief = [[1.0, 1.0, 1.0] if marks[node] else self.own(tree, node) for node in range(size)]
        step = [self.steps(mark[1]) if mark else self.edge for mark in marks]
        upward = [None] * size
        for node in range(size - 1, 0, -1):
            if tree.name[node] in CLAMPED:  # says nothing about where it stands
                upward[node] = [1.0, 1.0, 1.0]
                continue
            if marks[node]:  # what it holds does not tell whether it is a side part
                belief[node][EXCLUDED] = max(belief[node][FRAME], belief[node][CONTENT])
            a, b, c = belief[node]
            message = [row[0] * a + row[1] * b + row[2] * c for row in step[node]]
            whole = sum(message) or 1.0
            upward[node] = message = [m / whole for m in message]
            above = belief[tree.parent[node]]
            above = [x * m for x, m in zip(above, message)]
            whole = sum(above)
            # contradicting potentials leave the parent as it was
            if whole > 0:
                belief[tree.parent[node]] = [x / whole for x in above]
        final = [None] * size
        final[0] = belief[0]
        for node in range(1, size):
            above, message = final[tree.parent[node]], upward[node]
            cavity = [x / m if m > 0 else 0.0 for x, m in zip(above, message)]
            down = [sum(cavity[s] * step[node][s][t] for s in STATES) for t in STATES]
            own = [d * x for d, x in zip(down, belief[node])]
            whole = sum(own)
            final[node] = [x / whole for x in own] if whole > 0 else belief[node]
        return final

    def text(self, page):
        tree = parse(page)
        found = self.marginals(tree)
        return "\n".join(
            tree.text[node]
            for node, name in enumerate(tree.name)
            if name == "#text" and found[node][CONTENT] > max(found[node][FRAME], found[node][EXCLUDED])
        )


def trained(pages, sample=SAMPLE, id_column="page_id", html_column="html"):
    """The model, from at most `sample` pages."""
    ship(pages.sparkSession)
    place = F.xxhash64(F.col(id_column).cast("string"))
    chosen = (
        pages.where(F.col(id_column).isNotNull() & F.col(html_column).cast("string").rlike(NAMED))
        .select(F.col(id_column).alias("_pl_id"), place.alias("_pl_place"))
        .distinct()
        .orderBy("_pl_place", "_pl_id")
        .limit(sample)
    )
    # bounded by `sample` ids
    rows = pages.join(F.broadcast(chosen.select("_pl_id")), pages[id_column] == F.col("_pl_id")).select(
        F.col(html_column).cast("string")
    )
    counts = (
        rows.mapInArrow(_counts, "kind string, key string, state int, n long")
        .groupBy("kind", "key", "state")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    return Model({(row["kind"], row["key"], row["state"]): row["n"] for row in counts})


def extracted(pages, model, id_column="page_id", html_column="html", carried=("url",)):
    """(page_id, carried columns, text) of every page."""
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [model.text(page.as_py() or "") for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"]
            )

    source = pages.select(F.col(id_column).alias("page_id"), *carried, F.col(html_column).cast("string"))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes[:-1])
    return source.mapInArrow(run, f"{kinds}, text string")
