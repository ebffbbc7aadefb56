"""Plain-Python counterparts used by several tests."""

import re
from collections import defaultdict


def words(text):
    lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_set(text, size):
    found = words(text)
    if not found:
        return frozenset()
    if len(found) < size:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + size]) for k in range(len(found) - size + 1))


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, item):
        self.parent.setdefault(item, item)
        while self.parent[item] != item:
            item = self.parent[item]
        return item

    def link(self, one, other):
        one, other = self.find(one), self.find(other)
        if one != other:
            self.parent[max(one, other)] = min(one, other)


def near_duplicates(rows, size, percent=80):
    """(id, set size, component, kept) of every (id, text), all pairs compared."""
    groups, holders, sets = Groups(), defaultdict(list), []
    for position, (doc, text) in enumerate(rows):
        own = shingle_set(text, size)
        sets.append((doc, own))
        groups.find(doc)
        common = defaultdict(int)
        for shingle in own:
            for other in holders[shingle]:
                common[other] += 1
            holders[shingle].append(position)
        for other, count in common.items():
            other_doc, other_set = sets[other]
            if 100 * count >= percent * (len(own) + len(other_set) - count):
                groups.link(doc, other_doc)
    return {(doc, len(own), groups.find(doc), groups.find(doc) == doc) for doc, own in sets}
