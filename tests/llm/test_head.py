"""Pages that leave the end of their head out."""

from __future__ import annotations

from plumeline.llm import html_text


def test_head_ends_at_the_first_element_of_the_body():
    assert html_text.render("<html><head><title>T</title><p>text<p>more") == "text\n\nmore"
    assert html_text.render("<head><meta charset=x><link rel=y><style>p{}</style><div>a</div>b") == "a\nb"


def test_head_ends_at_text():
    assert html_text.render("<html><head><title>T</title>\n plain <b>text</b>") == "plain text"
    assert html_text.render("<head><script>x</script> &amp; more</head> and") == "& more and"


def test_head_keeps_its_content():
    page = "<html><head>\n<title>T</title> <template><p>no</p></template><noscript><p>no</p></noscript></head><body><p>yes</p></body></html>"
    assert html_text.render(page) == "yes"
    assert html_text.render("<html><head><title>T</title><body class=x><p>yes") == "yes"
