"""Plain-Python sequential fold: the reference's check-then-mark loop, used as
the brute-force oracle for the parallel ingest."""


def sequential_fold(rows, state_ids=(), state_hashes=()):
    """rows: iterable of (seq, channel_id, message_id, content_hash).
    Returns {seq: status} with status in new / dup_id / dup_content."""
    ids, hashes = set(state_ids), set(state_hashes)
    out = {}
    for seq, ch, mid, h in sorted(rows):
        if (ch, mid) in ids:
            out[seq] = "dup_id"
        elif h in hashes:
            out[seq] = "dup_content"
        else:
            out[seq] = "new"
            ids.add((ch, mid))
            hashes.add(h)
    return out
