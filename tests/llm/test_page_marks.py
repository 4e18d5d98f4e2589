"""The article's mark is one weight among others."""

from eventweave.llm import page_text

STORY = [f"Paragraph {k} of the story goes on for quite a while, so that its line has weight." for k in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in STORY)
CARDS = "".join(f"<article><h3><a href='/{k}'>Teaser {k}</a></h3><p>Short card {k}.</p></article>" for k in range(3))


def test_story_beside_teasers():
    assert page_text.main_text(f"<div>{BODY}</div><hr>" + "<p></p>" * 9 + CARDS).startswith(" ".join(STORY))
    mixed = page_text.main_text(f"<article><p>{'Marked text of some length. ' * 30}</p></article><div>{BODY}</div>")
    assert " ".join(STORY) in mixed


def test_mark_is_bounded():
    links = "".join(f"<p><a href='/{k}'>One more link to elsewhere number {k}</a></p>" for k in range(9))
    assert page_text.main_text(f"<article>{BODY}{links}</article>") == " ".join(STORY)
    assert page_text.main_text(f"<p>By a writer</p><article>{BODY}</article><p>Some more</p>") == " ".join(STORY)
    assert page_text.main_text(f"<article><h1><a href='/'>Title</a></h1>{BODY}</article>") == " ".join(["Title", *STORY])


def test_wrappers_with_marks():
    assert page_text.main_text(f"<form action='/'><p>Menu</p><div>{BODY}</div></form>") == " ".join(["Menu", *STORY])
    assert page_text.main_text(f"<div class='layout has-sidebar'><nav>No</nav>{BODY}</div><p>x</p>").startswith(STORY[0])
    assert STORY[0] not in page_text.main_text(f"<div class='comments'>{BODY}</div><p>x</p>")
    assert STORY[0] not in page_text.main_text(f"<div class='widget' hidden>{BODY}</div><p>x</p>")


def test_things_beside_a_short_article():
    one = "<article><p>One paragraph is all that this article has, and it is not long at all, so it is easily lost.</p></article>"
    text = "One paragraph is all that this article has, and it is not long at all, so it is easily lost."
    for thing in ("class='sidebar'", "class='cookie-notice'", "class='widget widget_text'", "id='sidebar-left'",
                  "class='newsletter'"):
        assert page_text.main_text(f"<div {thing}>{BODY}{BODY}</div>{one}") == text
        assert page_text.main_text(f"{one}<div {thing}>{BODY}{BODY}</div>") == text
    assert page_text.main_text(f"{one}<form><p>Write</p>{BODY}</form>") == text
    assert page_text.main_text(f"<aside>{BODY}</aside><div><p>{text}</p></div>") == text
    assert page_text.main_text(f"<article><p>{text}</p><div class='responses'>{BODY}</div></article>") == text


def test_short_pages():
    assert page_text.main_text("<nav><a href='/'>Home</a></nav><div><h1>Note</h1><p>Closed today.</p><p>Back soon.</p></div>"
                               ) == "Note Closed today. Back soon."
    assert page_text.main_text("<p>ok</p>") == "ok"
    assert page_text.main_text("<ul><li><a href='/a'>Home</a></li><li><a href='/b'>About</a></li></ul>") == ""


def test_sums_decide_inside_the_mark():
    links = "".join(f"<li><a href='/{k}'>Link number {k} to elsewhere</a></li>" for k in range(8))
    page = f"<article><p>Share</p><ul>{links}</ul><h1>Title</h1>{BODY}<p>Short.</p><ul>{links}</ul><p>Tags</p></article>"
    assert page_text.main_text(page) == " ".join(["Title", *STORY, "Short."])


def brute_block(weights, surge, dive, block=3):
    """Stretches of one part by the definition: from a surge to the next dive, zeros cut off, near ones joined."""
    sums = [sum(weights[i:i + block]) for i in range(len(weights))]
    out, i = [], 0
    while i < len(sums):
        if sums[i] < surge or not sums[i]:
            i += 1
            continue
        j = next((j for j in range(i, len(sums)) if sums[j] <= dive), len(sums))
        own = [k for k in range(i, j) if weights[k]]
        if own:
            if out and own[0] - out[-1][1] - 1 <= block:
                out[-1] = (out[-1][0], own[-1])
            else:
                out.append((own[0], own[-1]))
        i = max(j, i + 1)
    return out


def test_line_blocks_equal_brute_force():
    import random
    pick = random.Random(9)
    for _ in range(400):
        sizes = [pick.choice([0, 0, 3, 8, 30, 90, 200]) for _ in range(pick.randint(1, 30))]
        page = "".join(f"<p>{'x' * n}</p>" if n else f"<p><a href='/'>l{k}</a></p>" for k, n in enumerate(sizes))
        names = ["x" * n if n else f"l{k}" for k, n in enumerate(sizes)]
        top = max((sum(sizes[i:i + 3]) for i in range(len(sizes))), default=0)
        surge = min(page_text.SURGE, top / 2)
        found = brute_block(sizes, surge, page_text.DIVE * surge / page_text.SURGE)
        heavy = max((sum(sizes[a:b + 1]) for a, b in found), default=0)
        want = [names[k] for a, b in found if sum(sizes[a:b + 1]) >= page_text.SHARE * heavy for k in range(a, b + 1)]
        assert page_text.main_text(page) == " ".join(want)


def test_time_is_linear():
    import time
    for page in ("<div class='ad'>" * 60_000, "<div class='ad'>x" * 30_000 + "</div>" * 30_000,
                 "<form><p>some text</p>" * 20_000 + "</form>" * 20_000, "<script>" * 30_000, "<p>" * 200_000,
                 "<div class='has-sidebar'><p>words here</p>" * 15_000 + "</div>" * 15_000):
        began = time.time()
        page_text.main_text(page)
        assert time.time() - began < 10
