"""Plain Python model of the semantics, one change at a time."""

from itertools import groupby


def net_action(group):
    """Net action of the changes of one key in one bulk, in order."""
    op, doc = group[-1]
    if op == "-D":
        return "D", None
    if len(group) > 1 and op in ("+I", "+U"):
        return "U", doc
    if op == "+I":
        return "I", doc
    if op == "+U":
        return "R", doc
    return None, None


def merged(old, new):
    if isinstance(old, dict) and isinstance(new, dict):
        out = dict(old)
        for k, v in new.items():
            out[k] = merged(old[k], v) if k in old else v
        return out
    return new


def apply_action(collection, key, action, doc):
    if action == "D":
        collection.pop(key, None)
    elif action == "I":
        collection.setdefault(key, doc)
    elif action == "R":
        if key in collection:
            collection[key] = doc
    elif action == "U":
        collection[key] = merged(collection[key], doc) if key in collection else doc


def apply_bulks(base, changes):
    """``changes``: (key, bulk, seq, op, doc) in any order; returns the collection."""
    collection = {k: dict(v) for k, v in base.items()}
    ordered = sorted(changes, key=lambda c: (c[0], c[1], c[2]))
    for (key, _), group in groupby(ordered, key=lambda c: (c[0], c[1])):
        action, doc = net_action([(c[3], c[4]) for c in group])
        apply_action(collection, key, action, doc)
    return collection
