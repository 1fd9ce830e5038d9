"""Rows that the queries over invented pages must give, worked out by hand from the rules."""

from __future__ import annotations

import json

_ROOT = "https://www.psychologytoday.com/us/therapists/ca/los-angeles"
_CLEO = (
    "Cleo", "Ann Sample", "(555) 010-0123", "Trauma | Anxiety | Grief", "Anxiety", "Adults | Teen | Individuals", "Adults", "Teen",
    "Plan A | Plan B", "hybrid", "Individual Sessions $150 - $ 180", "$150-$180", "not_accepting_new_clients",
)
_PROFILE = "first_name last_name phone_number all_specialties best_specialty client_focus client_focus_primary client_focus_secondary insurance_details payment_category fee_raw fee_clean availability_status".split()
#: By priority: the root, contact, about, team, blog, then what the rules put last.
_ORDER = ("", "contact", "about-us", "team", "blog/a", "privacy")
_FEW = '["Only 6 same-site pages were collected (private +25).","Website text contains \'about me\' (private +5)."]'
# 25 + 5 for private against 3 + 7 for group: 50 + 30 // 2 + (30 - 10) // 3
_SCORE = 71


def _walk(site: str, paths: tuple[str, ...]) -> list[tuple]:
    return [(site, n, f"https://{site}/{path}", None) for n, path in enumerate(paths)]


def _mail(email: str, score: int, pages: list[str], sources: list[str], said: list[str]) -> str:
    return json.dumps({"email": email, "score": score, "pages": pages, "sources": sources, "evidence": said}, separators=(",", ":"))


def _seen(site: str, path: str, source: str, said: str) -> str:
    return f"{source} on https://{site}/{path}: {said}"


_OAK = [
    # 15 + 25 + 6 + 30 + 20 + 4, at most 90; 15 + 25 + 6 + 20 + 6
    _mail("jo.sample@oak.test", 90, ["https://oak.test/contact", "https://oak.test/about-us"], ["mailto", "text"], [_seen("oak.test", "contact", "mailto", "Write"), _seen("oak.test", "about-us", "text", "about me: jo.sample@oak.test")]),
    _mail("info@oak.test", 72, ["https://oak.test/contact"], ["mailto"], [_seen("oak.test", "contact", "mailto", "Write")]),
]
_ELM = [
    _mail("jo.sample@elm.test", 90, ["https://elm.test/contact"], ["mailto"], [_seen("elm.test", "contact", "mailto", "Write")]),
    _mail("info@elm.test", 72, ["https://elm.test/contact"], ["mailto"], [_seen("elm.test", "contact", "mailto", "Write")]),
    # 15 + 12 + 4 + 30 - 12
    _mail("jo.sample@oak.test", 49, ["https://elm.test/about-us"], ["text"], [_seen("elm.test", "about-us", "text", "about me: jo.sample@oak.test")]),
]

#: Query to (columns with SQL types, rows).
ROWS: dict[str, tuple[str, list[tuple]]] = {
    "discovery_progress": ("run_id INTEGER, page_no INTEGER, found BIGINT, unique_profile BIGINT, next_page_url VARCHAR", [(1, 1, 3, 3, f"{_ROOT}?page=2"), (1, 2, 3, 5, f"{_ROOT}?page=3")]),
    "profile_extract": (
        "source_profile_id VARCHAR, pt_website_redirect VARCHAR, " + ", ".join(f"{c} VARCHAR" for c in _PROFILE),
        [
            *((f"PT:{n}", f"https://www.psychologytoday.com/us/profile/{n}/website", *_CLEO) for n in (301, 302)),
            ("PT:303", "__unavailable__", *({"payment_category": "self_pay", "availability_status": "accepting_new_clients"}.get(c) for c in _PROFILE)),
        ],
    ),
    "crawl_frontier": (
        "site_id VARCHAR, seq INTEGER, page_url VARCHAR, error VARCHAR",
        [*_walk("elm.test", _ORDER[:5]), *_walk("oak.test", _ORDER[:5]), ("fir.test", None, None, "https://fir.test/about-us: status 404")],
    ),
    "crawl_by_url": (
        "site_id VARCHAR, seq INTEGER, page_url VARCHAR, error VARCHAR",
        [*_walk("elm.test", _ORDER), *_walk("oak.test", _ORDER), *_walk("fir.test", (*_ORDER[:2], *_ORDER[3:]))],
    ),
    "emails_in_hard_texts": (
        "page_url VARCHAR, email VARCHAR",
        [("p02", "x@b.test"), ("p03", "jo@c.test"), ("p06", "jo@f.test"), ("p08", "a+b@g.test"), ("p08", "c@g.test"), ("p10", "x@j.test"), ("p13", "x@m.test-y"), ("p14", "two@n.test.org")],
    ),
    "name_bonuses": ("k INTEGER, bonus INTEGER", [(1, 30), (2, 10), (3, 15), (4, 30), (5, 25), (6, 0), (7, 15), (8, 15)]),
    "run_progress": (
        "id INTEGER, status VARCHAR, pages_completed INTEGER, unique_profile INTEGER, next_page_url VARCHAR, last_error VARCHAR, ended BOOLEAN",
        [(1, "running", 2, 7, "https://d.test/1?page=3", None, False), (2, "completed", 0, 0, "https://d.test/2", None, True), (3, "pending", 0, 0, "https://d.test/3", "stopped", False)],
    ),
    "resumable_by_arguments": (
        "asked VARCHAR, id INTEGER",
        [("any, idle", 3), ("status, idle", 3), ("id, idle", 4), ("url, idle", 2), *((f"{x}, running", 7) for x in ("any", "status", "id", "url", "none"))],
    ),
    "website_enrichment": (
        "site_id VARCHAR, category VARCHAR, category_score INTEGER, category_evidence VARCHAR, best_email VARCHAR, best_email_score DOUBLE, all_emails VARCHAR, evidence_snippets VARCHAR",
        [
            ("elm.test", "private_practice", _SCORE, _FEW, "jo.sample@elm.test", 90.0, "jo.sample@elm.test | info@elm.test | jo.sample@oak.test", f"[{','.join(_ELM)}]"),
            ("oak.test", "private_practice", _SCORE, _FEW, "jo.sample@oak.test", 90.0, "jo.sample@oak.test | info@oak.test", f"[{','.join(_OAK)}]"),
        ],
    ),
}


def sql(name: str) -> str:
    """A query for the rows of ROWS[name]."""
    fields, rows = ROWS[name]
    names = [f.split(" ")[0] for f in fields.split(", ")]
    shown = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else repr(v)
    lines = ", ".join("(" + ", ".join(map(shown, r)) + ")" for r in rows)
    return f"SELECT {', '.join(f'CAST({n} AS {f.split(chr(32))[1]}) AS {n}' for n, f in zip(names, fields.split(', ')))} FROM (VALUES {lines}) AS t({', '.join(names)})"
