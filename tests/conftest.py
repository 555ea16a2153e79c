import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paperloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions="2", name="tests")
    yield session
    session.stop()


def _authorship(author, *places):
    return {"author": {"id": author}, "institutions": [{"id": place} for place in places]}


WORKS = [
    {
        "id": "M1",
        "title": "Tides",
        "doi": "https://doi.org/10.9/tides",
        "publication_year": 2016,
        "cited_by_count": 8,
        "primary_topic": {"id": "S1"},
        "topics": [{"id": topic} for topic in ("S1", "S2")],
        "authorships": [_authorship("N1", "H1", "H2"), _authorship("N2", "H1")],
        "open_access": {"is_oa": True, "oa_status": "diamond"},
    },
    {
        "id": "M2",
        "title": "Waves",
        "publication_year": 2017,
        "cited_by_count": 5,
        "primary_topic": {"id": "S1"},
        "topics": [{"id": "S1"}],
        "authorships": [_authorship("N1")],
        "open_access": {"is_oa": False, "oa_status": "closed"},
    },
    {"id": "M3", "title": "Swell", "publication_year": 2017},
    {"id": "M4"},
]


def write_extraction(folder, stem, lines, sidecar="{}"):
    """Lines may be dicts or raw text; no sidecar file when it is None."""
    text = lines if isinstance(lines, str) else "\n".join(
        line if isinstance(line, str) else json.dumps(line, ensure_ascii=False) for line in lines
    )
    path = folder / f"{stem}.jsonl"
    path.write_text(text, encoding="utf-8")
    if sidecar is not None:
        body = sidecar if isinstance(sidecar, str) else json.dumps(sidecar)
        (folder / f"{stem}.metadata.json").write_text(body, encoding="utf-8")
    return path


def rows(frame, *columns, order=None):
    frame = frame.select(*columns) if columns else frame
    found = [tuple(r) for r in frame.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r)) if order is None else found
