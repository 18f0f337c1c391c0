"""Elements that a page leaves open end where browsers end them, and the text behind them is read."""

import pytest

from lyceum.llm.page_blocks import Maker, blocks_of


@pytest.mark.parametrize("html,texts", [
    ("<html><head><title>T</title><body><p>a</p><p>b</p></body></html>", ["a", "b"]),
    ("<head><meta charset=x><script>x</script><style>y</style><div>a</div>b", ["a", "b"]),
    ("<head><title>T</title>a<p>b", ["a", "b"]),
    ("<head><link rel=x><a href=/x>a</a> b", ["a b"]),
    ("<head><title>T</title><img src=x>a", ["a"]),
    ("<head><noscript><p>x</p></noscript><template><p>y</p></template><title>T</title><p>a", ["a"]),
    ("<html><head><title>T</title></head><body>a<head>b</body>", ["ab"]),
    ("<body><svg><g><text>x</text><p>a</p><p>b</p>", ["a", "b"]),
    ("<div><svg><foreignObject><p>x</p></foreignObject><text>y</text></svg>a</div>", ["a"]),
    ("<math><mi>x</mi><div>a</div>", ["a"]),
    ("<svg><title>x</title><path></svg>a", ["a"]),
    ("<div><object data=x><param name=y><p>a</p><p>b</p></div><p>c", ["a", "b", "c"]),
    ("<p>a</p><object data=x><p>x</p>y</object><p>b", ["a", "b"]),
    ("<form><select><option>x<option>y<input><p>a</form>", ["a"]),
    ("<select><option>x<select><p>a", ["a"]),
    ("<table><tr><td><select><option>x<tr><td>a</table>b", ["a", "b"]),
    ("<select><option>x</select>a", ["a"]),
])
def test_text_behind_open_elements(html, texts):
    assert [b.text for b in blocks_of(html)] == texts


def test_generated_pages_without_end_of_head():
    maker = Maker(99)
    for _ in range(50):
        page = maker.page()
        assert page.count("</head>") == 1
        assert blocks_of(page.replace("</head>", "")) == blocks_of(page) != []
