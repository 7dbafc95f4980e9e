import re
import time

import numpy as np
import pytest

from riskspark.llm import html_text

N = 1_000_000
HOSTILE = {
    "tags without an end": "<a" * (N // 2),
    "comparisons": "if a<b and " * (N // 11),
    "one long name": "<" + "a" * N,
    "unclosed quotes": "<a x=\"<a y='" * (N // 12) + ">",
    "declarations": "<!" * (N // 2),
    "scripts": "<script>" + "</script" * (N // 8),
    "nested": "<div>" * 50_000 + "deep",
    "unmatched ends": "<i>" * 50_000 + "</u>" * 50_000,
    "items": "<li><ul>" + "<b>" * 40_000 + "<li></li>" * 40_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_is_linear_in_hostile_pages(name):
    model = html_text.default_model()
    began = time.process_time()
    html_text.extract([HOSTILE[name]], model)
    assert time.process_time() - began < 5


#: The grammar in one pattern: too slow for hostile pages, plain enough to compare with.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL)


def slowly(source):
    at = 0
    while m := TOKEN.search(source, at):
        name = m[2] and m[2].lower()
        yield source[at : m.start()], "text" if name is None else m[1], name or "", m[3] or ""
        at = m.end()
        if name in html_text.RAW and not m[1]:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
    yield source[at:], "text", "", ""


@pytest.mark.parametrize("failed", [0, html_text.FAILED])
def test_markup_follows_the_grammar(monkeypatch, failed):
    monkeypatch.setattr(html_text, "FAILED", failed)
    rng = np.random.default_rng(8)
    bits = ["<p>", "</p>", "<a href='x>y'>", "<b", '"', "'", ">", "<", '<div class="content">', "</div", "text ", "<!-- c -->", "<!x", "<?y>", "<script>", "</script>", "</scr", "<br/>", "<a x=", " "]
    for _ in range(3000):
        source = "".join(rng.choice(bits, rng.integers(1, 30)))
        assert list(html_text.Tags(source)) == list(slowly(source)), source


def test_layouts_that_training_has_not_seen():
    model = html_text.train(html_text.labelled_pages(layouts=html_text.LAYOUTS[:5]))
    forest = html_text.Forest()
    for page in html_text.labelled_pages(90, seed=5, layouts=html_text.LAYOUTS[5:]):
        forest.page(page)
    chars = np.array([len(x) for x in forest.text])
    said, gold = model.marginals(forest) >= 0.5, np.array(forest.gold) > 0
    print(chars[said & gold].sum() / chars[said].sum(), chars[said & gold].sum() / chars[gold].sum())
    assert chars[said & gold].sum() / chars[said].sum() > 0.9 and chars[said & gold].sum() / chars[gold].sum() > 0.9
