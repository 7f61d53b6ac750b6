"""Text of pages that browsers show in formulas, drawings, objects and inputs."""

import pytest

from crownframe.llm import html_text


@pytest.mark.parametrize(("markup", "text"), [
    ("a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b", "a x=1 b"),
    ("<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>", "1 2"), ("a<math display='block'><mi>x</mi></math>b", "a\nx\nb"),
    ("<math><semantics><mi>x</mi><annotation>tex</annotation><annotation-xml>y</annotation-xml></semantics></math>", "x"),
    ("<math><mi>a</mi><mphantom><mi>b</mi></mphantom><mtext>if <b>c</b></mtext></math>", "aif c"),
    ("<svg><title>t</title><desc>d</desc><metadata>m</metadata><g><text x=1>one</text><text>two</text></g></svg>z", "one two z"),
    ("<svg><title/><style/><defs/><path d='M0'/><text>a<tspan>b</tspan></text></svg><p>c</p>", "ab\n\nc"),
    ("<svg> loose <g>loose</g><text><![CDATA[1 < 2 &amp;]]></text></svg>", "1 < 2 &amp;"),
    ("<svg><text display=none>a</text><text visibility='hidden'>b</text><text>c</text></svg>", "c"),
    ("<svg><defs><text id=q>used</text></defs></svg>x<svg><use xlink:href='#q'/></svg>", "x used"),
    ("<svg><symbol id=s><text>s</text><use href='#s'/></symbol><use href='#s'/></svg>x", "x"),
    ("<svg><text>a</text><foreignObject><p>b<p>c</foreignObject></svg>d", "a\n\nb\n\nc\n\nd"),
    ("<svg><g><path><p>out", "out"), ("<desc>a</desc> <mask>b</mask>", "a b"), ("<svg/>x", "x"),
    ("<svg>" + "<path d='M0 0'/>" * 500 + "<text>deep</text></svg>x", "deep x"),
    ("<object data=x.pdf><param name=a value=b><p>no plugin</p></object>z", "no plugin\n\nz"),
    ("<object data=x>a<object data=y>b</object></object>", "ab"),
    ("<p aria-hidden=true>a <b>b</b></p><span aria-hidden='true'>c</span>", "a b\n\nc"),
    ("Name:<input value='Ann Lee'>!", "Name: Ann Lee !"), ("<input type=TEXT value=a><input type=search value=b>", "a b"),
    ("<input type=hidden value=a><input type=password value=b><input type=checkbox value=c>"
     "<input type=radio value=d><input type=range value=5><input type=color value='#fff'>x", "x"),
    ("<input type=email placeholder='you@x'><input placeholder=p value=v><textarea placeholder=q></textarea>", "you@x v q"),
    ("<input hidden value=a><input style='display:none' value=b><input type=submit value=Go>", "Go"),
    ("<ul><li><svg><text>a</text></svg><li>b</ul>", "- a\n- b"), ("<table><tr><td><math><mi>x</mi></math><td>y</table>", "x  y"),
])
def test_shown_text_is_emitted(markup, text):
    assert html_text.visible_text(markup) == text


@pytest.mark.parametrize(("markup", "text"), [
    ('<div style="backface-visibility: hidden">shown</div>', "shown"), ('<div style="-webkit-backface-visibility:hidden">shown</div>', "shown"),
    ("<p style=\"content:'display:none'\">shown</p>", "shown"), ("<p style='color:red; display : NONE'>not</p>x", "x"),
    ("<p style='display:none;display:block'>shown</p>", "shown"), ("<p style='/* x */display:none !important'>not</p>x", "x"),
    ("<p style='background:url(a;display:none)'>shown</p>", "shown"),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>shown</b>b</div>", "shown"),
    ("<div style='visibility:hidden'>a<p>b<i>c</i></div>x", "x"), ("<div style='visibility:collapse'><ul><li>a</ul></div>x", "x"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>", "- b"),
    ("<svg><g visibility=hidden><text>a</text><text visibility=visible>b</text></g></svg>", "b"),
    ("<div style='visibility:hidden'><img alt=a><input value=b></div>x", "x"),
])
def test_styles_are_read_as_declarations(markup, text):
    assert html_text.visible_text(markup) == text


@pytest.mark.parametrize("markup", ["<a ", "<a x=\"", "<a '", "<a <b \"", "<p title='a\"", "</a ", "<!-", "<table><tr><td>"])
def test_long_hostile_markup_takes_linear_time(markup):
    import time

    start = time.process_time()
    html_text.visible_text(markup * ((1 << 20) // len(markup)) if "table" not in markup else markup * 3000)
    assert time.process_time() - start < 4


def plain_grid(rows):
    """Columns at the widest line of their cells and two blanks; the lines of a cell below each other."""
    wide = [max((len(x) for r in rows if c < len(r) for x in r[c]), default=0) for c in range(max(map(len, rows)))]
    lines = []
    for r in rows:
        for k in range(max(map(len, r))):
            line = ""
            for c, cell in enumerate(r):
                if k < len(cell) and cell[k]:
                    line = line.ljust(sum(w + 2 for w in wide[:c])) + cell[k]
            if line:
                lines.append(line)
    return "\n".join(lines)


def test_tables_are_laid_out_as_a_plain_grid():
    import random

    rng = random.Random(7)
    for _ in range(200):
        rows = [[["".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(rng.choice([1, 1, 1, 2, 3]))] if rng.random() > 0.1 else [""]
                 for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 6))]
        markup = "<table>" + "".join("<tr>" + "".join(f"<td>{'<br>'.join(c)}</td>" for c in r) for r in rows) + "</table>"
        assert html_text.visible_text(markup) == plain_grid(rows)


def test_wide_rows_and_long_lines_keep_their_cells():
    many = "<table><tr>" + "".join(f"<td>{i}" for i in range(700)) + "<tr>" + "<td>x" * 700 + "</table>"
    first, second = html_text.visible_text(many).split("\n")
    assert first.split() == [str(i) for i in range(700)] and all(first[k - 2:k].isspace() for k in range(3, len(first)) if second[k:k + 1] == "x")
    long = "<table><tr><td>" + "w" * 5000 + "<td>a<tr><td>b<td>c</table>"
    assert html_text.visible_text(long) == "w" * 5000 + "  a\nb  c"
