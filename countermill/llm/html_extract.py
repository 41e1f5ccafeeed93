"""Main text of HTML pages by a linear-chain conditional random field over leaf blocks.

A page is a sequence of blocks (``page_blocks``). Features are the tags and the class, id and
role words of a block's ancestors, and figures of its text. Two labels, main text or not;
weights are trained by the likelihood of labelled pages, and a page is decoded by Viterbi.

Labelled pages: ``LABELLED_PAGES`` pages of the table (those of smallest hash, none over
``LABELLED_BYTES``), where ``article`` and ``main`` mark the main text; and the same texts laid
out anew in usual site layouts, so that pages marked otherwise, and notices, adverts, forms and
comments inside an article, are learned too. The sample bounds the training; extraction runs
over all pages, each one whole, inside Arrow tasks without a shuffle.

Defined results: a null or empty page, and one without text, gives an empty text; a page of
markup that never closes is read as far as it makes sense; repeated rows are read one by one;
null ids are carried; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countermill.llm.page_blocks import DROP, KEEP, Block, blocks

LABELLED_PAGES = 100
LABELLED_BYTES = 60_000
LABELLED_BLOCKS = 60
LAYOUTS_PER_PAGE = 6
STEPS = 200
L2 = 1e-5

_CONTENT_TAGS = ("article", "main")
_END = ".!?…:;\"'”’»)"


def features(block: Block, at: int, of: int) -> list[str]:
    """Names of what holds for a block."""
    words = block.text.split(" ")
    n = len(words)
    share = block.linked / max(1, len(block.text))
    out = ["bias"]
    out += [f"tag {t}" for t in block.tags]
    out += [f"name {x}" for x in block.names]
    out += [f"near {x}" for x in block.near]
    out.append(f"inner {block.inner}")
    out.append(f"words {min(6, n.bit_length())}")
    out.append(f"linked {0 if share == 0 else 1 if share < 0.5 else 2}")
    out.append(f"ends {block.text[-1] in _END}")
    out.append(f"commas {min(3, block.text.count(','))}")
    out.append(f"sign {any(c in block.text for c in '©|»›®')}")
    out.append(f"place {'first' if at == 0 else 'last' if at == of - 1 else 'middle'}")
    return out


def own_label(block: Block) -> int:
    """Label that the markup of a page itself gives."""
    inside = any(t in _CONTENT_TAGS for t in block.tags)
    return int(inside and not any(t in ("nav", "aside", "footer", "form", "header", "button") for t in block.tags))


#: Words that sites use in the class or id of the main text, and of what is around it.
_MAIN_NAMES = "article content main post entry story body text".split()
_OTHER_NAMES = (
    "ad ads advert advertisement sponsored sponsor promo banner cookie cookies consent notice alert popup newsletter"
    " subscribe signup login search sidebar widget related recommended teaser share social comment comments reply replies"
    " respond discussion header masthead topbar footer copyright disclaimer menu nav navbar navigation breadcrumb"
    " pagination tags meta tools"
).split()
_WRAPPERS = (
    "<article {}>{}</article>", "<main {}>{}</main>", "<main><article {}>{}</article></main>", "<main><div {}>{}</div></main>",
    "<div {}>{}</div>", "<section {}>{}</section>", '<div class="page"><div {}>{}</div></div>', "<table><tr><td {}>{}</td></tr></table>",
)
_PROSE = (
    "<div {}>{}</div>", "<div {}><p>{}</p></div>", "<section {}><p>{}</p></section>", "<section {}><div><p>{}</p></div></section>",
    "<p {}>{}</p>", "<div {}><h3>{}</h3></div>", "<div {}><ul><li>{}</li></ul></div>", "<form {}><label>{}</label><button>Ok</button></form>",
    "<aside {}><p>{}</p></aside>", "<footer {}>&copy; {}</footer>", "<footer {}><p>{}</p></footer>", "<header {}><h2>{}</h2></header>",
)
_BARE = ("<aside {}><p>{}</p></aside>", "<aside {}>{}</aside>", "<form {}><p>{}</p></form>", "<footer {}>{}</footer>", "<header {}>{}</header>")
_MENUS = ("<nav {}><ul>{}</ul></nav>", "<ul {}>{}</ul>", "<div {}><ul>{}</ul></div>")


def _attributes(mark: str, names: list[str], rng: random.Random) -> str:
    chosen = rng.choice("-_ ").join(rng.sample(names, rng.choice((1, 1, 2))))
    return f'{mark}="1" {rng.choice(("class", "class", "id"))}="{chosen}"'


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def laid_out(content: list[str], prose: list[str], rng: random.Random) -> str:
    """A page with the paragraphs in one of the usual layouts and other texts around and, at
    times, inside; marked with what is main text."""

    def aside() -> str:
        text = _escaped(rng.choice(prose))
        if rng.random() < 0.2:
            return rng.choice(_BARE).format(f'{DROP}="1"', text)
        return rng.choice(_PROSE).format(_attributes(DROP, _OTHER_NAMES, rng), text)

    def menu() -> str:
        words = [_escaped(w) for w in rng.choice(prose).split()[: rng.randint(2, 6)]]
        items = "".join(f'<li><a href="/{i}">{w}</a></li>' for i, w in enumerate(words))
        return rng.choice(_MENUS).format(_attributes(DROP, _OTHER_NAMES, rng), items)

    inner = [f"<h1>{_escaped(content[0][:60])}</h1>"] if rng.random() < 0.7 else []
    for paragraph in content:
        shape = rng.choices(
            ("<p>{}</p>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<h2>{}</h2>", "<div>{}</div>"),
            (80, 5, 5, 5, 5),
        )[0]
        inner.append(shape.format(_escaped(paragraph)))
        if rng.random() < 0.3:
            inner.append(aside())
    body = [menu() for _ in range(rng.randint(0, 2))] + [aside() for _ in range(rng.randint(0, 4))]
    named = _attributes(KEEP, _MAIN_NAMES, rng) if rng.random() < 0.8 else f'{KEEP}="1"'
    body.append(rng.choice(_WRAPPERS).format(named, "".join(inner)))
    body += [aside() for _ in range(rng.randint(0, 4))] + [menu() for _ in range(rng.randint(0, 1))]
    return f"<html><body>{''.join(body)}</body></html>"


def labelled_sequences(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Training sequences of the sampled pages and of their texts in other layouts."""
    out = []
    parsed = [blocks(p) for p in pages]
    others = [b.text for page in parsed for b in page if not own_label(b)]
    prose = [b.text for page in parsed for b in page if len(b.text) > 20]
    pool = (others + prose) or ["No text."]
    for number, page in enumerate(parsed):
        rng = random.Random(number)
        page = page[:LABELLED_BLOCKS] + page[max(LABELLED_BLOCKS, len(page) - 5) :]
        labels = [own_label(b) for b in page]
        if any(labels):
            out.append((page, labels))
        texts = [b.text for b, y in zip(page, labels) if y] or [b.text for b in page if len(b.text) > 40]
        for _ in range(LAYOUTS_PER_PAGE if texts else 0):
            begin = rng.randrange(len(texts))
            made = blocks(laid_out(texts[begin : begin + rng.randint(1, 8)], pool, rng))
            out.append((made, [b.label for b in made]))
    return out


class ChainModel:
    """Two-label linear-chain conditional random field with named features."""

    def __init__(self, sequences: list[tuple[list[Block], list[int]]]) -> None:
        self.place: dict[str, int] = {}
        named = [[features(b, i, len(page)) for i, b in enumerate(page)] for page, _ in sequences]
        for page in named:
            for names in page:
                for name in names:
                    self.place.setdefault(name, len(self.place))
        self.weight = np.zeros((len(self.place) + 1, 2))
        self.move = np.zeros((2, 2))
        if sequences:
            self._train(named, [y for _, y in sequences])

    def _train(self, named: list[list[list[str]]], labels: list[list[int]]) -> None:
        """Adam on the mean negative log-likelihood; all sequences step together, padded."""
        count, longest = len(named), max(map(len, named))
        width = max(len(names) for page in named for names in page)
        size = np.array([len(page) for page in named])
        there = np.arange(longest)[None, :] < size[:, None]
        real = int(there.sum())
        index = np.full((real, width), len(self.place))
        for row, names in enumerate(names for page in named for names in page):
            index[row, : len(names)] = [self.place[n] for n in names]
        gold = np.zeros((count, longest), dtype=int)
        gold[there] = [y for ys in labels for y in ys]
        moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (self.weight, self.move)]
        onehot = np.eye(2)[gold] * there[:, :, None]
        pair_gold = np.einsum("sti,stj->ij", onehot[:, :-1], onehot[:, 1:])
        for step in range(1, STEPS + 1):
            emit = np.zeros((count, longest, 2))
            emit[there] = self.weight[index].sum(axis=1)
            forward, backward = np.zeros((count, longest, 2)), np.zeros((count, longest, 2))
            forward[:, 0] = emit[:, 0]
            for t in range(1, longest):
                new = np.logaddexp.reduce(forward[:, t - 1, :, None] + self.move, axis=1) + emit[:, t]
                forward[:, t] = np.where(there[:, t, None], new, forward[:, t - 1])
            for t in range(longest - 2, -1, -1):
                new = np.logaddexp.reduce(self.move + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(there[:, t + 1, None], new, 0.0)
            total = np.logaddexp.reduce(forward[:, -1], axis=1)
            chance = np.exp(np.minimum(forward + backward - total[:, None, None], 0)) * there[:, :, None]
            joint = forward[:, :-1, :, None] + self.move + (emit + backward)[:, 1:, None, :] - total[:, None, None, None]
            pairs = (np.exp(np.minimum(joint, 0)) * there[:, 1:, None, None]).sum(axis=(0, 1))
            excess = (chance - onehot)[there]
            slope = np.zeros_like(self.weight)
            flat = index.reshape(-1)
            for y in (0, 1):
                slope[:, y] = np.bincount(flat, np.repeat(excess[:, y], width), len(slope))
            slope[-1] = 0
            for value, gradient, (m, v) in zip((self.weight, self.move), (slope, pairs - pair_gold), moments):
                gradient = gradient / real + L2 * value
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient**2 - v)
                value -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def decode(self, page: list[Block]) -> list[int]:
        """The likeliest labels of a page's blocks."""
        if not page:
            return []
        get, none = self.place.get, len(self.place)
        (a, b), (c, d) = self.move.tolist()
        back: list[tuple[int, int]] = []
        score = None
        for i, block in enumerate(page):
            e0, e1 = self.weight[[get(n, none) for n in features(block, i, len(page))]].sum(axis=0).tolist()
            if score is None:
                score = (e0, e1)
                continue
            s0, s1 = score
            to0, to1 = (s0 + a, s1 + c), (s0 + b, s1 + d)
            back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
            score = (max(to0) + e0, max(to1) + e1)
        label = int(score[1] > score[0])
        out = [label]
        for choice in reversed(back):
            label = choice[label]
            out.append(label)
        return out[::-1]

    def main_text(self, page: str | None) -> str:
        found = blocks(page)
        return "\n".join(b.text for b, y in zip(found, self.decode(found)) if y)


def train(pages: DataFrame) -> ChainModel:
    """The model of a bounded sample of the pages."""
    usable = pages.where(F.octet_length("html").between(1, LABELLED_BYTES)).select(
        "html", F.xxhash64("page_id", "html").alias("h")
    )
    # The hashes are chosen first, so that tasks send no page but those of the sample.
    least = usable.select("h").orderBy("h").limit(LABELLED_PAGES).agg(F.max("h")).first()[0]
    sample = usable.where(F.col("h") <= F.lit(least)).orderBy("h").limit(LABELLED_PAGES).collect()
    return ChainModel(labelled_sequences([r.html for r in sample]))


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: ChainModel = model.value
        for batch in batches:
            texts = [chain.main_text(page) for page in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return run, "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    model = pages.sparkSession.sparkContext.broadcast(train(rows))
    return rows.mapInArrow(*_extract(model))
