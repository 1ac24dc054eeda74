"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree. Each node is content or not; parent-child
potentials connect the nodes, and a node's own potential comes from its tag, its class, id
and role words, its amount of text and its share of link text. Sum-product messages pass
upward and downward, which on a tree gives the exact marginals. The text of nodes whose
content marginal passes one half is the main text.

Potentials are counted on labelled pages: a bounded sample of the table (``TRAIN_PAGES``)
whose nodes are labelled where their markup states what they are (article, main, nav,
footer and the like). The same words serve as pseudo-counts, so that the model knows them
even where the sample lacks them.

Texts of script, style and the like never show. Character references are decoded, white
space inside a block becomes one space, blocks are joined by a line feed. Null and empty
pages give an empty text. Broken markup is closed as browsers close it (a paragraph ends
where a block begins); no page fails. Repeated rows each get their row.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import hash_sample, text_of, texts

#: Most labelled pages that training uses.
TRAIN_PAGES = 1000

#: Elements without end tag, elements whose text never shows, block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe object svg textarea title".split())
BLOCK = frozenset("""address article aside blockquote body button canvas caption center dd
details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6
head header hgroup hr html legend li main menu nav ol option optgroup p pre search section
select summary table tbody td tfoot th thead tr ul""".split())
#: A start tag of the key closes an open element of the value.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
        "tbody": {"thead", "tbody", "tr", "td", "th"},
        "tfoot": {"thead", "tbody", "tr", "td", "th"}}
#: What bounds the search for an element to close.
SCOPE = frozenset("article aside body div footer form header html main nav section".split())

#: Words that state a node's part, in tag, class, id or role.
CONTENT = frozenset("""article main maincontent mainbody articlebody entrycontent postcontent
story storybody post entry""".split())
OTHER = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs header banner masthead
topbar footer sidebar aside rail widget ad ads advert adverts advertisement advertising
sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal
overlay paywall newsletter subscribe subscription signup login form search comment comments
commentlist disqus reply replies respond discussion reviews share sharing social related
recommended recommendations pagination pager toolbar copyright legal tags metadata dialog
button select fieldset complementary contentinfo""".split())
#: Pseudo-count of such a word, and least probability of a change between parent and child.
PRIOR, CHANGE = 1000.0, 0.02

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
                 |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""",
                 re.S | re.X)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")


class Page:
    """Nodes (block elements) in page order, parents first, and the texts they hold."""

    def __init__(self, source: str):
        self.parent, self.marks = [-1], [("root",)]
        self.text: list[tuple[int, int, str]] = []   # node, block number, text
        self.linked = [0]                            # link text per node
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("#root", 0)]
        block, links, at = 0, 0, 0

        def close(upto):
            nonlocal links, block
            while len(stack) > upto:
                name, _ = stack.pop()
                links -= name == "a"
                block += name in BLOCK

        def say(piece):
            if piece:
                node = stack[-1][1]
                self.text.append((node, block, piece))
                if links:
                    self.linked[node] += len(piece.strip())

        while True:
            m = TAG.search(source, at)
            if m is None:
                say(source[at:])
                return
            say(source[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == name:
                        close(i)
                        break
                    if name not in BLOCK and stack[i][0] in BLOCK:
                        break                        # an inline end tag stays in its block
                else:
                    if name == "p":
                        block += 1
                continue
            if name in RAW:
                if not m[3].endswith("/") or name not in ("svg",):
                    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I
                                     ).search(source, at)
                    at = end.end() if end else len(source)
                continue
            if name in VOID:
                if name == "br":
                    self.text.append((stack[-1][1], block, "\n"))
                elif name in BLOCK:
                    block += 1
                continue
            if name in BLOCK:
                block += 1
                ends = ENDS.get(name, ())
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p" or stack[i][0] in ends:
                        close(i)
                    elif stack[i][0] in SCOPE or stack[i][0] in ("table", "ul", "ol", "dl"):
                        break
                self.parent.append(stack[-1][1])
                self.marks.append(self._marks(name, m[3]))
                self.linked.append(0)
                stack.append((name, len(self.parent) - 1))
            else:
                links += name == "a"
                stack.append((name, stack[-1][1]))

    @staticmethod
    def _marks(name: str, attributes: str) -> tuple[str, ...]:
        out = ["<" + name]
        for m in ATTRIBUTE.finditer(attributes):
            for word in (m[2] or m[3] or m[4] or "").split():
                low = word.lower()
                parts = [x.lower() for x in WORDS.findall(word)]
                out += {low, "".join(parts), *parts}
        return tuple(dict.fromkeys(out))

    def features(self) -> list[tuple[str, ...]]:
        """Each node's marks, with the amount of its text and its share of link text."""
        size = [0] * len(self.parent)
        for node, _, t in self.text:
            size[node] += len(t.strip())
        whole, linked = size[:], self.linked[:]
        for i in range(len(size) - 1, 0, -1):        # children come behind their parents
            whole[self.parent[i]] += whole[i]
            linked[self.parent[i]] += linked[i]
        return [(*m, f"#size{min(10, int(math.log2(s + 1)))}",
                 f"#link{int(4 * min(1.0, n / w)) if w else 5}")
                for m, s, n, w in zip(self.marks, size, linked, whole)]

    def labels(self) -> list[int | None]:
        """What the markup states: 1 content, 0 other; a node takes over its parent's."""
        out: list[int | None] = []
        for i, m in enumerate(self.marks):
            above = out[self.parent[i]] if i else None
            words = {m[0][1:], *m[1:]}
            # Inside an article, header is the article's own head.
            other = words & OTHER - ({"header"} if above == 1 else set())
            if above == 0 or other:
                out.append(0)
            elif above == 1 or words & CONTENT:
                out.append(1)
            else:
                out.append(None)
        return out


class Model:
    """Potentials as logarithms: of marks (content less other) and of parent and child."""

    def __init__(self, pages: list[str]):
        marks, nodes = (Counter(), Counter()), [1.0, 1.0]
        pairs = [[1.0, 1.0], [1.0, 1.0]]
        for source in pages:
            page = Page(source)
            # Nodes whose markup states nothing teach nothing; the root is other.
            label = page.labels()
            label[0] = label[0] or 0
            for i, f in enumerate(page.features()):
                if label[i] is None:
                    continue
                nodes[label[i]] += 1
                marks[label[i]].update(f)
                above = label[page.parent[i]] if i else None
                if above is not None:
                    pairs[above][label[i]] += 1
        # The root is other; everything else is judged by its marks and its parent.
        self.pair = [[max(CHANGE, x / sum(row)) for x in row] for row in pairs]
        total = [n + 1000 for n in nodes]
        self.unit = math.log(total[0] / total[1])
        self.mark = {w: math.log((marks[1][w] + 1) / (marks[0][w] + 1)) + self.unit
                     for w in set(marks[0]) | set(marks[1])}
        for words, sign in ((CONTENT, 1), (OTHER, -1)):
            for w in words:
                for k in (w, "<" + w):
                    n1, n0 = marks[1][k], marks[0][k]
                    up = math.log((n1 + 1 + PRIOR * (sign > 0)) / (n0 + 1 + PRIOR * (sign < 0)))
                    self.mark[k] = up
        # Inside an article a header's marks say nothing of their own.
        self.mark["<header"] = self.mark["header"] = -2.0

    def marginals(self, page: Page) -> list[float]:
        """The probability of content of each node, by sum-product on the tree."""
        n = len(page.parent)
        own = []
        for f in page.features():
            x = sum(max(-8.0, min(8.0, self.mark.get(w, 0.0))) for w in f)
            x = max(-30.0, min(30.0, x))
            p = 1 / (1 + math.exp(-x))
            own.append([1 - p, p])
        own[0] = [1.0, 0.0]
        pair = self.pair
        up = [[1.0, 1.0] for _ in range(n)]           # message of a node to its parent
        below = [list(x) for x in own]                # own potential times children's messages
        for i in range(n - 1, 0, -1):
            a, b = below[i]
            m = [pair[0][0] * a + pair[0][1] * b, pair[1][0] * a + pair[1][1] * b]
            s = m[0] + m[1]
            up[i] = [m[0] / s, m[1] / s]
            q = below[page.parent[i]]
            q[0] *= up[i][0]
            q[1] *= up[i][1]
            s = q[0] + q[1]
            q[0], q[1] = q[0] / s, q[1] / s
        belief = [below[0]] + [[0.0, 0.0]] * (n - 1)
        out = [below[0][1]]
        for i in range(1, n):                         # parents come first
            above = belief[page.parent[i]]
            rest = [above[0] / max(up[i][0], 1e-300), above[1] / max(up[i][1], 1e-300)]
            s = rest[0] + rest[1]
            rest = [rest[0] / s, rest[1] / s]
            b = [below[i][c] * (rest[0] * pair[0][c] + rest[1] * pair[1][c]) for c in (0, 1)]
            s = b[0] + b[1]
            belief[i] = [b[0] / s, b[1] / s] if s > 0 else [0.5, 0.5]
            out.append(belief[i][1])
        return out

    def main_text(self, source: str) -> str:
        if not source:
            return ""
        page = Page(source)
        content = self.marginals(page)
        blocks: list[str] = []
        now, parts = None, []
        for node, block, t in [*page.text, (-1, -1, "")]:
            if block != now:
                whole = " ".join(html.unescape("".join(parts)).split())
                if whole:
                    blocks.append(whole)
                now, parts = block, []
            if node >= 0 and content[node] > 0.5:
                parts.append(t)
        return "\n".join(blocks)


def fit_content(pages: DataFrame, source: str = "html", rows: int = TRAIN_PAGES) -> Model:
    """The model from at most about ``rows`` distinct pages, chosen by a hash of their text."""
    page = text_of(source)
    sample = hash_sample(pages.where(page != "").select(page.alias("t")), F.col("t"),
                         rows).dropDuplicates(["t"])
    return Model(sorted(texts(sample.toArrow().column("t"))))


def main_texts(pages: DataFrame, model: Model, source: str = "html") -> DataFrame:
    """``pages`` with text and n_chars in place of the markup (and of columns so named)."""
    own = [c for c in pages.columns if c not in (source, "text", "n_chars")]
    kept = pages.select(F.struct(*own).alias("own"), text_of(source).alias("t"))
    kind = kept.schema["own"].dataType.simpleString()

    def rows(batches):
        for b in batches:
            got = [model.main_text(t) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(got, pa.string()),
                 pa.array([len(x) for x in got], pa.int64())], names=["own", "text", "n_chars"])

    return kept.mapInArrow(rows, f"own {kind}, text string, n_chars bigint").select(
        "own.*", "text", "n_chars")
