import math
import random
import re
from collections import defaultdict
from itertools import groupby

from linewise.llm.urltree import judge_urls

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in RULES:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path, best and best[1], best and best[0]


def make(seed, n=400):
    rng = random.Random(seed)
    hosts = ["a.example.net", "EXAMPLE.net", "x.example.com", "example.com", "b.org", "notnet", "net", "my.net:80", "É.Example.com", "user@b.org"]
    paths = ["", "/", "/en/1", "/en", "/de/x?y=/fr/", "/fr/#a", "/fr/a/b/", "//", "/en/post-12.html", "/é/ü", "/" + "d/" * 30, "?q=://z", "#f"]
    urls = [rng.choice(["http://", "https://", "", "://", "a://b://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(n)]
    return [(i, u, "h", "r") for i, u in enumerate([*urls, None, "", "://", "http:/x.net/", "x\ny://h.net/\nen/"])]


def test_hosts_paths_and_rules(spark):
    rows = make(2)
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in judge_urls(pages, labels, RULES).collect()}
    assert len(got) == len(rows)
    for key, url, *_ in rows:
        host, path, rule, verdict = brute(url)
        r = got[key]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), url


def test_bad_branches_are_told_apart(spark):
    pages, labels = [], []
    for k in range(600):
        kind = ("spam", "news", "blog")[k % 3]
        pages.append((k, f"http://one.com/{kind}/{k}/item-{k}.html"))
        if k % 2:
            labels.append((k, 0 if kind == "spam" else 1, 0))
    pages += [(1000 + k, f"http://two.com/{k}") for k in range(40)]
    labels += [(1000 + k, 0, 0) for k in range(30)] + [(1001, 0, 0), (None, 0, 0), (5, None, None), (99999, 0, 1)]
    pages += [(2000, "http://few.com/a"), (None, "http://few.com/a")]
    labels += [(2000, 0, 0)]
    got = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULES).collect()
    verdicts = {(r.host, r.path.split("/")[1], r.template): r.verdict for r in got}
    assert verdicts["one.com", "spam", "/*+/*/*"] == "block"
    assert verdicts["one.com", "news", "/*-/*/*"] == verdicts["one.com", "blog", "/*-/*/*"] == "allow"
    assert {v for (h, *_), v in verdicts.items() if h == "two.com"} == {"block"}
    assert {v for (h, *_), v in verdicts.items() if h == "few.com"} == {"allow"}
    assert len(got) == len(pages)


def test_a_rare_bad_branch_among_many_is_told_apart(spark):
    kinds = [chr(97 + k // 6) + chr(97 + k % 6) for k in range(30)]
    pages = [(k, f"http://wide.com/{kinds[k % 30]}/{k}") for k in range(6000)] + [(6000 + k, f"http://wide.com/rare/{k}") for k in range(60)]
    labels = [(k, 1, 0) for k in range(0, 6000, 7)] + [(6000 + k, 0, 0) for k in range(60)]
    got = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULES).collect()
    assert {(r.path.startswith("/rare/"), r.verdict) for r in got} == {(True, "block"), (False, "allow")}


def test_names_with_digits_take_the_label_test(spark):
    kinds = ("casino365", "news24", "mp3", "about", "2024", "item-{}.html")
    pages = [(k, f"http://digits.com/{kinds[k % 6].format(k)}/{k}") for k in range(1200)]
    pages += [(2000 + k, f"http://years.com/{('2024', f'x{k % 40}a')[k % 2]}/{k}") for k in range(400)]
    labels = [(k, 0 if k % 6 == 0 else 1, 0) for k in range(600)] + [(2000 + k, k % 2, 0) for k in range(400)]
    got = judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULES).collect()
    assert len(got) == len(pages)
    assert {(r.path.startswith("/casino365/"), r.verdict) for r in got if r.host == "digits.com"} == {(True, "block"), (False, "allow")}
    assert {(r.path.startswith("/2024/"), r.verdict) for r in got if r.host == "years.com"} == {(True, "block"), (False, "allow")}
    assert {r.template for r in got if "item-" in r.path} == {"/*/*"}


def test_empty_table(spark):
    pages, labels = spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert judge_urls(pages, labels, RULES).count() == 0


def frame(spark, pages, labels):
    return judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), RULES)


def test_unlike_branches_are_not_pooled(spark):
    pages, labels = [], []
    for name, n, bad in (("casino", 200, 200), ("forum", 2000, 500), ("news", 6000, 0)):
        for k in range(n):
            pages.append((len(pages), f"http://three.com/{name}/{k}"))
            labels.append((len(labels), int(k >= bad), 0))
    got = frame(spark, pages, labels).collect()
    assert {(r.path.split("/")[1], r.verdict) for r in got} == {("casino", "block"), ("forum", "allow"), ("news", "allow")}
    assert len({r.template for r in got}) == 3


def test_branches_must_be_alike_further_down_too(spark):
    for between in ("", "1/", "same/"):
        pages = [(k, f"http://cross.com/{'xy'[k % 2]}/{between}{'ab'[k // 2 % 2]}/{k}") for k in range(2000)]
        labels = [(k, int(k % 2 == k // 2 % 2), 0) for k in range(2000)]
        got = frame(spark, pages, labels).collect()
        assert all((r.verdict == "allow") == (r.page_id % 2 == r.page_id // 2 % 2) for r in got)


def test_deep_paths_have_no_last_level(spark):
    for deep in (12, 300):
        pages = [(k, f"http://deep.com/{'s/' * deep}{('good', 'bad')[k % 2]}/{k}") for k in range(1000)] + [(5000, "http://deep.com/s/s"), (5001, "http://deep.com/" + "t/" * 3000)]
        labels = [(k, 1 - k % 2, 0) for k in range(1000)]
        got = frame(spark, pages, labels).filter("page_id < 5000").collect()
        assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in got)


def plain_tree(rows, delta=0.05):
    """Templates of ``(host, shape, labelled, bad)`` rows: the same definitions, node by node, on one machine."""
    bound, inner_bound = (math.sqrt(math.log(2 / d) / 2) for d in (delta, delta / 10))

    def apart(n, b, all_n, all_b, bound):
        m, c = all_n - n, all_b - b
        return m > 0 and abs(b / n - c / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def sums(items):
        out = defaultdict(lambda: [0, 0])
        for key, n, b in items:
            out[key][0] += n
            out[key][1] += b
        return out

    waiting = [((), rows)]
    skips, names = {}, {}
    while waiting:
        done, own = waiting.pop()
        live = [r for r in own if r[0]]
        if not live or sum(n for _, n, _ in live) <= bound**2:
            continue
        shapes = [s for s, *_ in live]
        skip = 0
        while all(len(s) > skip and s[skip] == shapes[0][skip] for s in shapes):
            skip += 1
        skips[done] = skip
        here = done + ("*",) * skip
        deeper = [(s[skip], s[skip + 1 :], n, b) for s, n, b in live if len(s) > skip]
        children = sums((p, n, b) for p, _, n, b in deeper)
        all_n, all_b = sum(n for n, _ in children.values()), sum(b for _, b in children.values())
        groups = defaultdict(list)
        for part, (n, b) in children.items():
            if n <= bound**2:
                continue
            inner = frozenset(
                (key, wn * (b - wb) < wb * (n - wn)) for key, (wn, wb) in sums(((j, s), m, c) for p, rest, m, c in deeper if p == part for j, s in enumerate(rest)).items()
                if wn > inner_bound**2 and apart(wn, wb, n, b, inner_bound)
            )
            if inner or apart(n, b, all_n, all_b, bound):
                groups[inner].append((min(256, math.floor(256 * b / n)), part, n, b))
        for inner, members in groups.items():
            clusters = []
            for share, some in groupby(sorted(members), key=lambda m: m[0]):
                some = list(some)
                n, b = sum(m[2] for m in some), sum(m[3] for m in some)
                if clusters and abs(b / n - clusters[-1][1] / clusters[-1][0]) <= bound * (1 / math.sqrt(n) + 1 / math.sqrt(clusters[-1][0])):
                    clusters[-1] = [clusters[-1][0] + n, clusters[-1][1] + b, clusters[-1][2] + [m[1] for m in some]]
                else:
                    clusters.append([n, b, [m[1] for m in some]])
            for k, (_, _, parts) in enumerate(clusters):
                for part in parts:
                    names[here, part] = (k, inner)
        nexts = defaultdict(list)
        for p, rest, n, b in deeper:
            nexts[here + (names.get((here, p), "*"),)].append((rest, n, b))
        waiting += nexts.items()

    def template(shape):
        done, at = (), 0
        while at < len(shape):
            step = min(skips.get(done, 0), len(shape) - at)
            done, at = done + ("*",) * step, at + step
            if at < len(shape):
                done, at = done + (names.get((done, shape[at]), "*"),), at + 1
        return done

    return template


def test_templates_against_a_plain_tree(spark):
    rng = random.Random(8)
    pages, labels = [], []
    for h in range(12):
        weights = {}
        words = [f"w{chr(97 + k)}" for k in range(rng.randint(2, 7))]
        for _ in range(500):
            shape = tuple(rng.choice(words) if rng.random() < 0.8 else f"u{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(rng.randint(0, 4)))
            shape = ("top",) * (h % 3) + shape
            key = shape[: h % 3 + rng.randint(1, 2)]
            bad = weights.setdefault(key, rng.choice((0.0, 0.02, 0.5, 0.9, 1.0)))
            pages.append((len(pages), f"http://h{h}.com/{'/'.join(shape)}" if shape else f"http://h{h}.com"))
            if rng.random() < 0.9:
                labels.append((pages[-1][0], int(rng.random() >= bad), 0))
    got = frame(spark, pages, labels).collect()
    known = dict((k, 1 - q) for k, q, _ in labels)
    prior = sum(known.values()) / len(known)
    hosts = defaultdict(list)
    for r in got:
        hosts[r.host].append(r)
    named = 0
    for rows in hosts.values():
        shapes = {r.page_id: tuple(r.path[1:].split("/")) if r.path else () for r in rows}
        template = plain_tree([(shapes[r.page_id], 1, known[r.page_id]) for r in rows if r.page_id in known])
        want = defaultdict(list)
        for r in rows:
            want[template(shapes[r.page_id])].append(r)
        assert len({r.template for r in rows}) == len(want)
        for key, some in want.items():
            assert len({r.template for r in some}) == 1
            marks = [known[r.page_id] for r in some if r.page_id in known]
            bad = (sum(marks) + 5 * prior) / (len(marks) + 5) if marks else prior
            assert {r.verdict for r in some} == {"block" if bad > 0.5 else "allow"}
            named += any(part != "*" for part in key)
    assert named > 30
