"""Pages that once ended the job, lost text or showed too much, and mutated pages without end."""

import random

import pytest

from pluvia.llm.html_text import render

CASES = [
    ("<![foo[bar]]>x", "x"),
    ("<![CDATA[a]]>b", "b"),
    ("<style>" + "@media screen{" * 2000 + "p{display:none}" + "}" * 2000 + "</style><p>q</p>z", "z"),
    ("<style>@media print{@media screen{p{display:none}}}</style><p>q</p>", "q"),
    ("a<!-- x", "a"),
    ("a<!bogus", "a"),
    ('<div style="visibility:hidden">h<b style="visibility:visible">v</b></div>', "v"),
    ("<style>.h{visibility:hidden}.v{visibility:visible}</style><p class=h>no <i class=v>yes</i></p>", "yes"),
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("<details>no<summary>sum</summary>no</details><details open><summary>s</summary>body</details>", "sum\ns\nbody"),
    ("<style>@media not print{p{display:none}}</style><p>q</p>z", "z"),
    ("<ol start=3 reversed><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n6. c"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"),
    ("<ol start=-1><li>a<li>b</ol>", "-1. a\n0. b"),
    ("<table><tr><td>漢字<td>b<tr><td>abcd<td>c</table>", "漢字  b\nabcd  c"),
    ("<table><tr><td>é<td>b<tr><td>ab<td>c</table>", "é   b\nab  c"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert "\n".join(x for x in render(page).split("\n") if x) == text


def test_mutated_pages_never_fail():
    rnd = random.Random(11)
    bits = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<ul>", "<ol reversed>", "<li value=x>", "</ul>", "<![if x]>", "<![foo[", "]]>", "<!--", "-->", "<!doctype", "<?php", "&#xFFFFFFF;", "&", "<style>", "</style>", "@media screen{", "p{display:none", "}", "<div style='visibility:hidden", "'>", "<details>", "<summary>", "<dialog", " open>", "<pre>", "\t", "x", "漢", "<script>", "</script>", "<", ">", "<textarea>", "</", "<select><option>", "<b x=\"", "\"", "<svg><![CDATA[", "\x00", "<blockquote>"]
    for _ in range(10_000):
        render("".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 30))))
    render("<ul><li>" * 3000 + "x" + "<blockquote>" * 3000 + "<table><tr><td>" * 3000)
