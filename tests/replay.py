"""Sequential replay of a change feed, one event after the other: the meaning of every policy."""

import random


def route(database, collection):
    return f"{collection}_shared" if collection != "c2" else f"{database}_{collection}"


def random_events(seed, n=400, ns_uids=False, first_seq=0):
    rng = random.Random(seed)
    events = []
    seqs = rng.sample(range(first_seq, first_seq + 10 * n), n)
    for seq in sorted(seqs):
        database, collection = rng.choice(["db0", "db1"]), rng.choice(["c0", "c1", "c2"])
        p = rng.random()
        if p < 0.02:
            events.append((seq, "drop", database, collection, None, None, None))
            continue
        if p < 0.028:
            events.append((seq, "drop_database", database, None, None, None, None))
            continue
        op = rng.choices(["insert", "update", "delete"], [3, 5, 2])[0]
        uid = f"u{rng.randrange(8)}"
        if ns_uids:
            uid = f"{database}-{collection}-{uid}"
        if op == "delete":
            events.append((seq, op, database, collection, uid, None, None))
        else:
            ext = {k: [f"{k}{seq}"] for k in ("x", "y") if rng.random() < 0.4}
            value = None if rng.random() < 0.1 else seq * 7
            events.append((seq, op, database, collection, uid, value, ext))
    return events


def replay(events, policy, base=()):
    """Live documents as {key: (database, collection, uid, value, ext)}."""
    docs = {}

    def key_of(database, collection, uid):
        return (database, collection, uid) if policy.key == "namespace" else (route(database, collection), uid)

    for database, collection, uid, value, ext in base:
        docs[key_of(database, collection, uid)] = (database, collection, uid, value, dict(ext))
    for _, op, database, collection, uid, value, ext in sorted(events, key=lambda e: e[0]):
        if op == "drop":
            for k, d in list(docs.items()):
                same = d[1] == collection
                if policy.drop_scope == "namespace":
                    same = same and d[0] == database
                else:
                    same = same and route(d[0], d[1]) == route(database, collection)
                if same:
                    del docs[k]
            continue
        if op == "drop_database":
            for k, d in list(docs.items()):
                if policy.drop_database == "all" or (policy.drop_database == "database" and d[0] == database):
                    del docs[k]
            continue
        key = key_of(database, collection, uid)
        if op == "delete":
            docs.pop(key, None)
        elif op == "insert" or policy.update == "replace":
            docs[key] = (database, collection, uid, value, dict(ext))
        elif policy.update == "merge" and key in docs:
            docs[key] = (database, collection, uid, value, {**docs[key][4], **ext})
    return docs


def orphan_updates(events, policy, base=()):
    """Sequence numbers of merging updates without a document."""
    orphans = []
    for i, e in enumerate(events):
        if e[1] != "update":
            continue
        before = replay(events[:i], policy, base)
        key = e[2:5] if policy.key == "namespace" else (route(e[2], e[3]), e[4])
        if key not in before:
            orphans.append(e[0])
    return orphans
