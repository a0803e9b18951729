"""The window rules, stated naively, for comparison."""


def windows(tokens, max_tokens, ratio):
    """(first row, last row, tokens) of every window."""
    n, keep, found, start = len(tokens), int(max_tokens * ratio), [], 0

    def size(a, b):
        return sum(tokens[a:b])

    while start < n:
        stop = next((b for b in range(start + 1, n + 1) if size(start, b) > max_tokens), n + 1) - 1
        if stop == start:  # a row over the budget
            found.append((start, start, tokens[start]))
            start += 1
            continue
        found.append((start, stop - 1, size(start, stop)))
        if stop == n:
            break
        again = next(k for k in range(start, stop + 1) if size(k, stop) <= keep) if ratio > 0 else stop
        start = again if size(again, stop + 1) <= max_tokens else stop
    return found


def split(line, limit):
    """Chunks of a line over the limit: its words, packed by the cost of a word and a blank."""
    words = line.split()
    packed = windows([max(1, (len(word) + 1) // 4) for word in words], limit, 0.0)
    return [" ".join(words[a:b + 1]) for a, b, _ in packed]
