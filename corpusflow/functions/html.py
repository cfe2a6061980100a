"""Element selection and block extraction over whole HTML strings.

Built from Spark's string and array functions, so an extraction is one narrow
projection over the scan: no shuffle and no Python worker.

A page is tokenized once: comments, scripts, styles, tags and what lies between. In a
``visible`` page the first three are gone, in a ``masked`` one their angle brackets are
control characters, one for one; so are those inside a quoted attribute. Afterwards
every "<" starts a tag and every ">" ends one, and no pattern sees a tag that a parser
would not. What is selected or removed from a masked page are slices of it, and
``unmasked`` gives them back in the page's own characters. The *_sql forms take and
give SQL text and expect such a page; the others are their Column forms and take the
page as it is.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sql import TO_END, apply, bind, lam, lit
from .text import WS_CLASS, contains_any_sql, drop_tags_sql, first_present, plain, plain_sql, trim_sql

_OPEN, _NAME_END, _CLOSE, _BREAK = "\u0001", "\u0002", "\u0003", "\u0004"

# Elements whose end also ends any list item or paragraph before it.
_ENDS = "p|li|ul|ol|h1|h2|h3|h4|h5|h6|main|article|body|html"
# Elements that end a paragraph or heading, but may stand inside a list item.
_BREAKS = (
    "div|section|table|thead|tbody|tr|td|th|blockquote|header|footer|nav|aside|"
    "figure|figcaption|form|dl|dt|dd|hr|pre"
)


# Stand for "<" and ">" where these are no part of a tag.
_LESS, _MORE = "\u0005", "\u0006"
_HIDDEN = _LESS + _MORE
# the rest of a tag: quoted values may hold anything
_REST = "(?:[^<>=]++|=\\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+>"
# comments, scripts and styles where no quoted value can hide one; and those with all other tags
_UNSEEN = "(?is)<(?:!--.*?-->|(script|style)(?=[\\s/>]).*?(?:</\\1\\s*>|\\z))"
_TOKENS = f"(?is)<(?:!--.*?-->|(script|style)(?=[\\s/>]){_REST}.*?(?:</\\1\\s*>|\\z)|/?[a-z]{_REST})"
# a quoted value that holds a bracket; one that holds what looks like a comment, script or style
_QUOTED = "=\\s*(?:\"[^\"<>]*[<>]|'[^'<>]*[<>])"
_QUOTED_UNSEEN = "(?i)=\\s*(?:\"[^\"]*?<(?:!--|script|style)|'[^']*?<(?:!--|script|style))"
# comments, scripts and styles of a masked page: one tag each
_MASKED_COMMENT = "<!--[^>]*>"
_MASKED_UNSEEN = f"(?i)<(?:!--|(?:script|style)(?=[\\s/>{_MORE}]))[^>]*(?:>|\\z)"


def _masked_tokens_sql(x: str, tokens: str) -> str:
    """x with the brackets inside its tokens hidden: each token, then the gap behind it."""

    def hidden(t):
        def without(part):
            return f"translate({part}, '<>', {lit(_HIDDEN)})"

        closed = f"concat('<', {without(f'substr({t}, 2, length({t}) - 2)')}, '>')"
        # an angle bracket behind the first character that is not the last one
        return (
            f"CASE WHEN NOT {t} RLIKE '(?s)^<[^<>]*[<>].' THEN {t} WHEN endswith({t}, '>') THEN {closed} "
            f"ELSE concat('<', {without(f'substr({t}, 2)')}) END"
        )

    def joined(gaps):
        each = f"transform(regexp_extract_all({x}, {lit(tokens)}, 0), (t, i) -> concat({hidden('t')}, {gaps}[i + 1]))"
        return f"concat({gaps}[0], array_join({each}, ''))"

    return f"CASE WHEN {x} RLIKE {lit(tokens)} THEN {bind(f'split({x}, {lit(tokens)})', joined)} ELSE {x} END"


def _own_sql(x: str) -> str:
    found = " OR ".join(f"contains({x}, {lit(c)})" for c in _HIDDEN)
    return f"CASE WHEN {found} THEN translate({x}, {lit(_HIDDEN)}, '') ELSE {x} END"


def _tokenized_sql(x: str, unseen, quoted_unseen) -> str:
    """Comments, scripts and styles first; then, on the few pages that have them, quoted brackets."""
    first = bind(
        bind(x, _own_sql),
        lambda v: f"CASE WHEN {v} RLIKE {lit(_QUOTED_UNSEEN)} THEN {quoted_unseen(v)} ELSE {unseen(v)} END",
    )
    return bind(first, lambda v: f"CASE WHEN {v} RLIKE {lit(_QUOTED)} THEN {_masked_tokens_sql(v, _TOKENS)} ELSE {v} END")


def masked_sql(x: str) -> str:
    """The page with "<" and ">" only where tags start and end; comments, scripts and styles become one tag each."""
    return _tokenized_sql(x, lambda v: _masked_tokens_sql(v, _UNSEEN), lambda v: _masked_tokens_sql(v, _TOKENS))


def visible_sql(x: str) -> str:
    """The page without comments, scripts and styles, and with "<" and ">" only where tags start and end."""
    return _tokenized_sql(
        x,
        lambda v: f"regexp_replace({v}, {lit(_UNSEEN)}, '')",
        lambda v: f"regexp_replace({_masked_tokens_sql(v, _TOKENS)}, {lit(_MASKED_UNSEEN)}, '')",
    )


def visible(html: Column) -> Column:
    """What a reader of the page can see, as the *_sql forms expect it."""
    return apply(html, visible_sql)


def unmasked_sql(x: str) -> str:
    def shown(v):
        found = " OR ".join(f"contains({v}, {lit(c)})" for c in _HIDDEN)
        return f"CASE WHEN {found} THEN translate({v}, {lit(_HIDDEN)}, '<>') ELSE {v} END"

    return bind(x, shown)


def _of_page(html: Column, body) -> Column:
    """A slice of the page: selected on the masked form, given back in its own characters."""
    return apply(html, lambda v: unmasked_sql(bind(masked_sql(v), body)))


def _open_tag(tag: str, attr: str | None = None) -> str:
    """Regex of an opening tag, optionally with something inside its attributes."""
    if attr is None:
        return f"(?is)<{tag}(?:\\s[^>]*)?>"
    return f"(?is)<{tag}\\s[^>]*{attr}[^>]*>"


def class_attr(name: str) -> str:
    """Attribute regex: the class list holds this exact class."""
    return f"class\\s*=\\s*[\"'](?:[^\"'>]*\\s)?{name}(?:\\s[^\"'>]*)?[\"']"


def class_like(part: str) -> str:
    """Attribute regex: the class list holds this text anywhere."""
    return f"class\\s*=\\s*[\"'][^\"'>]*{part}[^\"'>]*[\"']"


def id_attr(name: str) -> str:
    return f"id\\s*=\\s*[\"']{name}[\"']"


def _balanced_sql(x: str, tag: str, attr: str | None, found, missing: str) -> str:
    """found(before, inside, after) for the first matching element, else missing."""
    close = lit(f"</{tag}>")
    opens = lit(f"(?i)<{tag}[\\s>]")

    # Walk the closing tags: each piece opens some nested elements and ends by
    # closing one. The element ends where the depth returns to zero.
    def walk(pieces):
        return (
            f"aggregate({pieces}, named_struct('depth', 1, 'n', 0), (acc, p) -> CASE WHEN acc.depth <= 0 THEN acc "
            f"ELSE named_struct('depth', acc.depth + regexp_count(p, {opens}) - 1, 'n', acc.n + 1) END, acc -> acc.n)"
        )

    def parts(head):
        return bind(
            f"split({head}[1], {lit(f'(?i)</{tag}' + chr(92) + 's*>')})",
            lambda pieces: bind(
                walk(pieces),
                lambda n: found(
                    f"{head}[0]",
                    f"array_join(slice({pieces}, 1, {n}), {close})",
                    f"array_join(slice({pieces}, {n} + 1, {TO_END}), {close})",
                ),
            ),
        )

    return bind(
        f"split({x}, {lit(_open_tag(tag, attr))}, 2)",
        lambda head: f"CASE WHEN size({head}) > 1 THEN {parts(head)} ELSE {missing} END",
    )


def element_sql(x: str, tag: str, attr: str | None = None) -> str:
    return _balanced_sql(x, tag, attr, lambda before, inside, after: inside, "CAST(NULL AS STRING)")


def element(html: Column, tag: str, attr: str | None = None) -> Column:
    """Inner HTML of the first matching element, nested same-name tags included.

    NULL where there is none.
    """
    return _of_page(html, lambda v: element_sql(v, tag, attr))


def container_sql(x: str, choices) -> str:
    picks = [x if c is None else element_sql(x, *c) for c in choices]
    return picks[0] if len(picks) == 1 else f"coalesce({', '.join(picks)})"


def container(html: Column, choices) -> Column:
    """First element found among choices, tried in order; NULL where none is there.

    Each choice is (tag, attribute regex or None), or None for the whole page.
    """
    return _of_page(html, lambda v: container_sql(v, choices))


def strip_comments_sql(x: str) -> str:
    return f"regexp_replace({x}, {lit(_MASKED_COMMENT)}, '')"


def strip_comments(html: Column) -> Column:
    return _of_page(html, strip_comments_sql)


def _whole(tag: str) -> str:
    if tag in ("script", "style"):  # one tag each in a masked page
        return f"(?i)<{tag}(?:[\\s/{_MORE}][^>]*)?(?:>|\\z)"
    return f"(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}\\s*>"


def _by_depth_sql(x: str, tag: str) -> str:
    """Text outside all elements of the tag, however deep they nest."""
    opened = f"regexp_replace(translate({x}, '\u0001\u0002', ''), {lit(f'(?i)<{tag}(?:' + chr(92) + 's[^>]*)?>')}, '\u0001')"
    marked = f"regexp_replace({opened}, {lit(f'(?i)</{tag}' + chr(92) + 's*>')}, '\u0002')"
    # Walk the pieces with the depth and the place where the kept stretch began; a
    # stretch is written down when an element of depth 0 starts, so nested ones cost nothing.
    stretch = "array_append(acc.kept, named_struct('a', acc.since, 'n', acc.at - acc.since))"

    def walk(pieces):
        return (
            f"aggregate({pieces}, named_struct('depth', 0, 'at', 1, 'since', 1, 'kept', CAST(array() AS ARRAY<STRUCT<a: INT, n: INT>>)), (acc, p) -> "
            "CASE WHEN startswith(p, '\u0001') THEN named_struct('depth', acc.depth + 1, 'at', acc.at + 1, 'since', acc.since, "
            f"'kept', CASE WHEN acc.depth = 0 THEN {stretch} ELSE acc.kept END) "
            "WHEN startswith(p, '\u0002') THEN named_struct('depth', greatest(acc.depth - 1, 0), 'at', acc.at + 1, "
            "'since', CASE WHEN acc.depth = 1 THEN acc.at ELSE acc.since END, 'kept', acc.kept) "
            "ELSE named_struct('depth', acc.depth, 'at', acc.at + 1, 'since', acc.since, 'kept', acc.kept) END, "
            f"acc -> CASE WHEN acc.depth = 0 THEN {stretch} ELSE acc.kept END)"
        )

    def joined(pieces):
        return bind(
            walk(pieces),
            lambda kept: f"translate(array_join(flatten(transform({kept}, k -> slice({pieces}, k.a, k.n))), ''), '\u0002', '')",
        )

    return bind(f"split({marked}, '(?=[\u0001\u0002])')", joined)


def strip_tags_sql(x: str, tags) -> str:
    def one(acc, tag):
        # most pages hold no such element within itself: then no end tag is left over
        def checked(v):
            return bind(
                f"regexp_replace({v}, {lit(_whole(tag))}, '')",
                lambda done: f"CASE WHEN {done} RLIKE {lit('(?i)</' + tag + '[^a-zA-Z]')} THEN {_by_depth_sql(v, tag)} ELSE {done} END",
            )

        return bind(acc, checked)

    return reduce(one, tags, x)


def strip_tags(html: Column, tags) -> Column:
    """Remove elements with their content, those nested in one of the same name included."""
    return _of_page(html, lambda v: strip_tags_sql(v, tags))


def drop_element_sql(x: str, tag: str, attr: str) -> str:
    return bind(
        x,
        lambda v: _balanced_sql(v, tag, attr, lambda before, inside, after: f"concat({before}, {after})", v),
    )


def drop_element(html: Column, tag: str, attr: str) -> Column:
    """Remove the first matching element, nested same-name tags included."""
    return _of_page(html, lambda v: drop_element_sql(v, tag, attr))


def mark_sql(x: str, elements) -> str:
    """Mark where chosen elements start and where blocks end."""
    tags = "|".join(sorted(elements, key=len, reverse=True))
    h = f"translate({x}, {lit(_OPEN + _NAME_END + _CLOSE + _BREAK)}, '')"
    h = f"regexp_replace({h}, {lit(f'(?i)<({tags})(?:' + chr(92) + 's[^>]*)?>')}, {lit(f'{_OPEN}$1{_NAME_END}')})"
    h = f"regexp_replace({h}, {lit(f'(?i)</(?:{_ENDS})' + chr(92) + 's*>')}, {lit(_CLOSE)})"
    return f"regexp_replace({h}, {lit(f'(?i)</?(?:{_BREAKS}|{_ENDS})(?:' + chr(92) + 's[^>]*)?>')}, {lit(_BREAK)})"


def split_sql(x: str, elements, sep: str) -> str:
    """Marked text, tags dropped, to blocks."""
    inner_break = lit(f"[{WS_CLASS}]*{_BREAK}[{WS_CLASS}{_BREAK}]*")

    def block(piece):
        tag = f"lower(substring_index({piece}, {lit(_NAME_END)}, 1))"
        body = f"substring_index(substring_index({piece}, {lit(_NAME_END)}, -1), {lit(_CLOSE)}, 1)"
        cut = f"substring_index({body}, {lit(_BREAK)}, 1)"
        if "li" in elements:
            cut = f"CASE WHEN {tag} = 'li' THEN regexp_replace({body}, {inner_break}, {lit(sep)}) ELSE {cut} END"
        return f"named_struct('tag', {tag}, 'text', {trim_sql(cut)})"

    found = f"transform(slice(split({x}, {lit(_OPEN)}), 2, {TO_END}), {lam(block)})"
    return f"filter({found}, b -> b.text <> '')"


def blocks_sql(x: str, elements=("p",), sep: str = " ") -> str:
    return split_sql(drop_tags_sql(mark_sql(x, elements), sep), elements, sep)


def blocks(html: Column, elements=("p",), sep: str = " ") -> Column:
    """Chosen elements in document order as array<struct<tag, text>>, blanks left out.

    A block runs from its opening tag to its end, or to the start of the next
    chosen element, so unclosed paragraphs work and no text is counted twice.
    ``sep`` joins the text nodes inside a block.
    """
    return apply(html, lambda v: bind(visible_sql(v), lambda m: blocks_sql(m, elements, sep)))


def cut_at_sql(x: str, markers, tag: str | None = None, ignore_case: bool = False) -> str:
    text = "lower(b.text)" if ignore_case else "b.text"
    stops = " OR ".join(f"contains({text}, {lit(m)})" for m in markers)
    if tag:
        stops = f"b.tag = {lit(tag)} AND ({stops})"
    return bind(
        x,
        lambda f: bind(
            f"CAST(array_position(transform({f}, b -> {stops}), true) AS INT)",
            lambda n: f"CASE WHEN {n} > 0 THEN slice({f}, 1, {n} - 1) ELSE {f} END",
        ),
    )


def cut_at(found: Column, markers, tag: str | None = None, ignore_case: bool = False) -> Column:
    """Keep the blocks before the first one that holds a marker.

    With ``tag``, only blocks of that element can stop the text.
    """
    return apply(found, lambda v: cut_at_sql(v, markers, tag, ignore_case))


def skip_blocks_sql(x: str, phrases=(), prefix: str | None = None) -> str:
    tests = [f"NOT contains(b.text, {lit(p)})" for p in phrases]
    if prefix is not None:
        tests.append(f"NOT startswith(b.text, {lit(prefix)})")
    return f"filter({x}, b -> {' AND '.join(tests)})" if tests else x


def skip_blocks(found: Column, phrases=(), prefix: str | None = None) -> Column:
    """Leave out blocks that hold a phrase or start with a prefix."""
    return apply(found, lambda v: skip_blocks_sql(v, phrases, prefix))


def join_blocks_sql(x: str, joiner: str = "\n") -> str:
    return f"array_join(transform({x}, b -> b.text), {lit(joiner)})"


def join_blocks(found: Column, joiner: str = "\n") -> Column:
    return apply(found, lambda v: join_blocks_sql(v, joiner))


def heading_sql(x: str, tag: str = "h1", attr: str | None = None) -> str:
    """Inner HTML of the first such heading, NULL where there is none."""
    return f"nullif(regexp_extract({x}, {lit(_open_tag(tag, attr) + '(.*?)</' + tag + chr(92) + 's*>')}, 1), '')"


def title(html: Column, tag: str = "h1", attr: str | None = None) -> Column:
    """Text of the first heading, NULL where there is none."""
    return apply(html, lambda v: plain_sql(bind(visible_sql(v), lambda m: heading_sql(m, tag, attr))))


def pick_title(listing_title: Column, page_title: Column) -> Column:
    """The listing's title where it has one, else the page's heading."""
    return F.coalesce(first_present(listing_title), page_title)


_DT_DD = "(?is)<dt(?:\\s[^>]*)?>(.*?)</dt>\\s*<dd(?:\\s[^>]*)?>(.*?)</dd>"


def meta_pairs_sql(x: str, labels=()) -> str:
    """All pairs, or those in which one of the labels is written, as (label, value)."""
    def pair(p):
        label = plain_sql(f"regexp_extract({p}, {lit(_DT_DD)}, 1)")
        return f"named_struct('label', lower({label}), 'value', regexp_extract({p}, {lit(_DT_DD)}, 2))"

    found = f"regexp_extract_all({x}, {lit(_DT_DD)}, 0)"
    if labels:
        # only what may be wanted is cleaned
        found = f"filter({found}, {lam(lambda p: contains_any_sql(f'lower({p})', labels))})"
    return f"transform({found}, {lam(pair)})"


def meta_pairs(html: Column) -> Column:
    """Label/value list as array<struct<label, value>>; labels are plain lower-case text."""
    own = lam(lambda p: f"named_struct('label', {p}.label, 'value', {unmasked_sql(f'{p}.value')})")
    return apply(html, lambda v: f"transform({bind(visible_sql(v), meta_pairs_sql)}, {own})")


def meta_list(html: Column, label: str) -> Column:
    """Link texts of the values under a label, as an array; empty where absent."""
    anchor = lit("(?is)<a(?:\\s[^>]*)?>(.*?)</a>")

    def links(v):
        wanted = f"filter({bind(visible_sql(v), lambda m: meta_pairs_sql(m, [label]))}, m -> m.label = {lit(label)})"
        found = f"flatten(transform({wanted}, m -> regexp_extract_all(m.value, {anchor}, 1)))"
        return f"transform({found}, {lam(plain_sql)})"

    return apply(html, links)
