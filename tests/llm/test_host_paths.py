"""The reader of op7 against a plain one that looks at every block for every container, and its time on deep pages."""

from __future__ import annotations

import random
import time

import pytest

from wavecount.llm.host_paths import ENOUGH, _Page

TAGS = ("div", "article", "section", "p", "h1", "body", "main", "td", "a", "ul", "header")
ATTRIBUTES = ("", " class=x", " class=y1", " class='b a'", " hidden", ' class="a>b"')


def _some_page(chance):
    parts = [lambda: f"<{chance.choice(TAGS)}{chance.choice(ATTRIBUTES)}>", lambda: f"</{chance.choice(TAGS)}>",
             lambda: "w" * chance.randint(1, 40) + " "]
    return "".join(chance.choice(parts)() for _ in range(chance.randint(0, 60)))


class _Plain:
    """Paths as lists of steps; sets of blocks for every container."""

    def __init__(self, page):
        self.blocks = [(self._steps(page, n), t, links, k in page.headings) for k, (n, t, links) in enumerate(page.blocks)]
        self.known = [self._steps(page, n) for n, c in enumerate(page.container) if c]

    @staticmethod
    def _steps(page, node):
        return page.path(node).split(">") if node >= 0 else []

    def on(self, steps):
        return {k for k, (s, *_) in enumerate(self.blocks) if s[: len(steps)] == steps}

    def scores(self):
        out = {}
        for steps in self.known:
            total = 0.0
            for k in self.on(steps):
                inner, text, links, _ = self.blocks[k]
                further = sum(len(steps) < len(c) and inner[: len(c)] == c for c in self.known)
                total += (len(text) - 2.0 * links) * 0.5**further
            total *= {"article": 3.0, "main": 2.0}.get(steps[-1].split(".")[0], 1.0)
            if total > 0:
                out[">".join(steps)] = total
        return out

    def gain(self, blocks):
        return sum(max(0, len(self.blocks[k][1]) - 2 * self.blocks[k][2]) for k in blocks)

    def choice(self):
        own = self.scores()
        if not own:
            return None
        chosen = min((p.split(">") for p in own), key=lambda s: (-own[">".join(s)], s))
        for n in range(len(chosen) - 1, 0, -1):
            above = chosen[:n]
            if len(chosen) <= n or above not in self.known:
                continue
            more, held = self.on(above), self.on(chosen)
            heading = any(self.blocks[k][3] for k in more - held)
            kinds = [s.split(".")[0] for s in chosen]
            whole = [k for k, s in enumerate(kinds) if s in ("article", "main")]
            if whole and n - 1 < whole[-1]:
                accepted = heading
            elif kinds[n - 1] == "body":
                accepted = heading or self.gain(more - held) * 10 >= self.gain(held)
            else:
                accepted = True
            if self.gain(more - held) and accepted:
                chosen = above
        return chosen

    def text(self, path):
        own, won = self.choice(), path.split(">") if path and path.split(">") in self.known else None
        if own is None and won is None:
            return " ".join(t for _, t, *_ in self.blocks)
        blocks = self.on(won) if won else set()
        if own and own != won and self.gain(blocks) < ENOUGH * self.gain(self.on(own)):
            blocks = self.on(own)
        return " ".join(self.blocks[k][1] for k in sorted(blocks))


def test_reader_equals_a_plain_one():
    chance = random.Random(7)
    for _ in range(1_500):
        page = _Page(_some_page(chance))
        plain, scores = _Plain(page), page.scores()
        assert {page.path(n): s for n, s in scores.items()} == plain.scores()
        chosen = page.choice(scores)
        assert (None if chosen is None else page.path(chosen).split(">")) == plain.choice()
        for path in (None, "div>no", *(">".join(s) for s in plain.known[:3])):
            assert page.text(path) == plain.text(path)
        keys = page.keys()
        assert len(set(keys)) == len(keys) == len({page.path(n) for n in range(len(keys))})


@pytest.mark.parametrize("source, n_words", [
    ("<div>two words " * 66_000, 132_000), ("<div>x" * 80_000 + "</section>" * 50_000, 80_000),
    ("<div>x" * 60_000 + "</div>" * 60_000, 60_000), ("<div>" * 200_000, 0)])
def test_deep_pages_take_time_by_their_length(source, n_words):
    """About a megabyte each; by the square of the depth any of them would take many minutes."""
    started = time.process_time()
    page = _Page(source)
    text = page.text(None)
    page.keys()
    assert len(text.split()) == n_words and time.process_time() - started < 20
