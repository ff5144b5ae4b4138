"""The rules applied one submission at a time, as the plain meaning to compare with."""


def registrations(regs, taken):
    names, out = set(taken), {}
    for event_id, _, username, password in sorted(regs, key=lambda r: (r[1], r[0])):
        if username is None or password is None:
            verdict = "400"
        elif password == "":
            verdict = "Password is required"
        elif username == "":
            verdict = "Username is required"
        elif username in names:
            verdict = f"User {username} is already registered."
        else:
            names.add(username)
            verdict = "ok"
        out[event_id] = verdict
    return out


def edits(rows, posts, accounts):
    """Verdicts by event id given the ids of all accounts, and the posts that remain as id -> (author, title, body)."""
    posts, out = dict(posts), {}
    for event_id, _, post_id, actor, title, body, op in sorted(rows, key=lambda r: (r[1], r[0])):
        if actor is None or actor not in accounts:
            verdict = "login"
        elif post_id not in posts or posts[post_id][0] not in accounts:
            verdict = "404"
        elif posts[post_id][0] != actor:
            verdict = "403"
        elif op == "delete":
            del posts[post_id]
            verdict = "ok"
        elif title is None or body is None:
            verdict = "400"
        elif title == "":
            verdict = "Title is required."
        else:
            posts[post_id] = (actor, title, body)
            verdict = "ok"
        out[event_id] = verdict
    return out, posts


def sessions(acts):
    """(client, number, start, last request, requests) of each session."""
    turns, open_now, out = {}, {}, {}
    for event_id, ts, client, kind in sorted(acts, key=lambda r: (r[1], r[0])):
        client = (client, event_id if client is None else None)
        if kind in ("login", "logout"):
            turns[client] = turns.get(client, 0) + 1
            open_now[client] = kind == "login"
            if kind == "login":
                out[client, turns[client]] = [ts, ts, 0]
        elif open_now.get(client):
            session = out[client, turns[client]]
            session[1] = ts
            session[2] += 1
    return sorted(((client, n, *rest) for ((client, _), n), rest in out.items()), key=str)


def notices(acts):
    """event id -> when its message was shown, None if never."""
    waiting, out = {}, {}
    for event_id, ts, client, kind in sorted(acts, key=lambda r: (r[1], r[0])):
        queue = waiting.setdefault((client, event_id if client is None else None), [])
        if kind in ("flash_redirect", "flash_render"):
            queue.append(event_id)
            out[event_id] = None
        if kind in ("view", "flash_render"):
            out.update((message, ts) for message in queue)
        if kind in ("view", "flash_render", "clear"):
            queue.clear()
    return out
