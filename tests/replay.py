"""Plain sequential replay of ride events, independent of the library."""

import math

# The weights of the score and the bounds of the surge price below must be these.


def score(request, lat, lon, gender, rating, salary):
    distance = math.sqrt((lat - request["latitude"]) ** 2 + (lon - request["longitude"]) ** 2)
    wanted = request["gender_preference"]
    fits = gender is not None and wanted is not None and wanted in ("N", gender)
    return (math.exp(-distance) * 0.4 + (0.2 if fits else 0.0)
            + rating / 5.0 * 0.2 + (1 - salary / 100.0) * 0.2)


def replay(events, consume, location_wins=False):
    """events: dicts in arrival order. Returns (requests, final drivers)."""
    drivers, places, last = {}, {}, {}
    requests = []
    for e in events:
        if e["latitude"] is None or e["longitude"] is None:
            continue
        block, driver = e["block_id"], e["driver_id"]
        here = drivers.setdefault(block, {})
        if e["type"] == "DRIVER_LOCATION":
            if driver is not None:
                places[block, driver] = (e["latitude"], e["longitude"], e["seq"])
        elif driver is not None:
            if e["type"] == "RIDE_COMPLETE" or (
                e["type"] == "ENTERING_BLOCK" and e["status"] == "AVAILABLE"
            ):
                here[driver] = (e["latitude"], e["longitude"], e["gender"], e["rating"], e["salary"], e["seq"])
            elif e["type"] == "LEAVING_BLOCK":
                here.pop(driver, None)
        else:
            best, best_score, candidates = None, 0.0, {}
            for d in sorted(here, key=str):
                lat, lon, gender, rating, salary, seq = here[d]
                place = places.get((block, d))
                if place and (location_wins or place[2] > seq):
                    lat, lon = place[:2]
                s = candidates[d] = score(e, lat, lon, gender, rating, salary)
                if s > best_score:
                    best, best_score = d, s
            n, price = len(here), 1.0
            if block in last and (last[block] + n) / 2 < 4.5:
                price = 1 + 2 * (4.5 - (last[block] + n) / 2) / 1.25
            requests.append({
                "seq": e["seq"], "block_id": block, "client_id": e["client_id"], "drivers": n,
                "driver_id": best, "score": best_score, "price": price, "previous": last.get(block),
                "candidates": candidates,
            })
            last[block] = n
            if consume and best is not None:
                del here[best]
    return requests, {(b, d): v for b, ds in drivers.items() for d, v in ds.items()}
