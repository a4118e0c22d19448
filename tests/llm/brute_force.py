"""Near duplicates by comparing every pair of different texts."""


def _shingles(words):
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def classes(rows):
    """(doc_id, class_id, n_links, n_copies) per row; ids are unique."""
    groups = {}
    for doc, text, *_ in rows:
        words = tuple((text or "").encode().split())
        groups.setdefault(words or ("row", doc), []).append(doc)
    keys = sorted(groups, key=lambda k: min(groups[k]))
    sets = {k: set() if k[0] == "row" else _shingles(k) for k in keys}
    links = {k: [] for k in keys}
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 5 * common >= 4 * len(sets[a] | sets[b]):
                links[a].append(b)
                links[b].append(a)
    label, out = {}, []
    for key in keys:
        if key in label:
            continue
        todo = [key]
        while todo:
            k = todo.pop()
            if k not in label:
                label[k] = min(groups[key])
                todo += links[k]
    for key in keys:
        out += [(d, label[key], len(links[key]), len(groups[key])) for d in groups[key]]
    return sorted(out)
