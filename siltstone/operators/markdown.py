"""HTML pages to Markdown with regular expressions only, so that the whole conversion stays in the JVM.

Scripts, styles, heads, navigation, footers and comments go; headings, lists,
paragraphs, breaks, bold text and links are kept. The patterns are written in
the common part of Java's and RE2's syntax.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (pattern, replacement with \1 for a group), applied in order.
STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(?:script)[ >].*?</script>|<(?:style)[ >].*?</style>|<head[ >].*?</head>|<nav[ >].*?</nav>|<footer[ >].*?</footer>|<noscript[ >].*?</noscript>", ""),
    (r"[ \t\r\n]+", " "),
    (r"(?i) *<h1(?: [^>]*)?> *", "\n\n# "),
    (r"(?i) *<h2(?: [^>]*)?> *", "\n\n## "),
    (r"(?i) *<h3(?: [^>]*)?> *", "\n\n### "),
    (r"(?i) *<h[4-6](?: [^>]*)?> *", "\n\n#### "),
    (r"(?i) *</h[1-6]> *", "\n\n"),
    (r"(?i) *<li(?: [^>]*)?> *", "\n- "),
    (r"(?i) *<br */?> *", "\n"),
    (r"(?i)</?(?:b|strong)(?: [^>]*)?>", "**"),
    (r"(?i)<a(?: [^>]*)? href=\"([^\"]*)\"[^>]*>(.*?)</a>", r"[\2](\1)"),
    (r"(?i) *</?(?:p|div|article|section|ul|ol|table|tr|blockquote|body|html|main|header|title)(?: [^>]*)?/?> *", "\n\n"),
    (r"(?i)<!doctype[^>]*>", ""),
    (r"</?[A-Za-z][^>]*>", ""),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;|&apos;", "'"),
    (r"&middot;", "·"),
    (r"&copy;", "©"),
    (r"&amp;", "&"),
    (r"[ ]+\n", "\n"),
    (r"\n[ ]+", "\n"),
    (r"\n\n\n+", "\n\n"),
    (r"^[ \n]+|[ \n]+$", ""),
)


def html_to_markdown(html: Column) -> Column:
    """Markdown of a page; null stays null."""
    out = html
    for pattern, replacement in STEPS:
        out = F.regexp_replace(out, pattern, replacement.replace("$", r"\$").replace(r"\1", "$1").replace(r"\2", "$2"))
    return out


def html_to_markdown_sql(column: str) -> str:
    """The same conversion for an engine with RE2."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = column
    for pattern, replacement in STEPS:
        out = f"regexp_replace({out}, {quote(pattern)}, {quote(replacement)}, 'g')"
    return out
