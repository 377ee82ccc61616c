"""Two small raw batches of every entity for tests of the whole chain.

All batches hold the keys in ``SHARED``, so a second one makes a second version of them. The second business and user of a
batch carry a field that the fixed schema does not know.
"""

from __future__ import annotations

import json
import os

SHARED = {"business": "shop-common", "user": "person-common"}


def batch(tag: str, n: dict[str, int]) -> dict[str, list[dict]]:
    shops = [SHARED["business"]] + [f"shop-{tag}-{i}" for i in range(n["business"] + 1)]
    people = [SHARED["user"]] + [f"person-{tag}-{i}" for i in range(n["user"] + 1)]
    day = "2024-{:02d}-{:02d}".format
    out = {
        "business": [{"business_id": k, "name": f"Shop {tag} {i}", "city": "Here", "state": "ST", "stars": 3.5, "review_count": i + ord(tag),
                      "is_open": 1, "categories": "Bakery, Cafe"} for i, k in enumerate(shops)],
        "user": [{"user_id": k, "name": f"Person {tag} {i}", "review_count": i + ord(tag), "yelping_since": "2023-05-06 07:08:09", "useful": i, "funny": 0,
                  "cool": 1, "elite": "", "friends": "", "fans": 0, "average_stars": 4.0} for i, k in enumerate(people)],
        "review": [{"review_id": f"r-{tag}-{i}", "user_id": people[i % len(people)], "business_id": shops[i % len(shops)], "stars": 1.0 + i % 5,
                    "useful": i % 3, "funny": 0, "cool": 0, "text": "Fresh bread. Mail a.b@example.org or ring (212) 555-0199.",
                    "date": day(1 + i % 12, 1 + i % 28) + " 09:10:11"} for i in range(n["review"])],
        "checkin": [{"business_id": shops[i % len(shops)], "date": f"{day(1 + i % 12, 3)} 10:00:00, {day(1 + i % 12, 4)} 11:00:00"} for i in range(n["checkin"])],
        "tip": [{"user_id": people[i % len(people)], "business_id": shops[i % len(shops)], "text": "Go early", "date": day(1 + i % 12, 5), "compliment_count": i % 2}
                for i in range(n["tip"])]}
    out["business"][1]["data_quality_tag"] = "seen"
    out["user"][1]["user_loyalty_tier"] = "first"
    return out


def write(root: str, dt: str, sizes: dict[str, int], tag: str = "a") -> None:
    """One batch under the raw layer's folders."""
    for entity, rows in batch(tag, sizes).items():
        folder = os.path.join(root, f"entity={entity}", f"dt={dt}")
        os.makedirs(folder)
        with open(os.path.join(folder, "rows.json"), "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
