"""A small interpreter from which engines are forked; only the standard library is used here.

A fork copies the page tables of its parent. A task's worker with its libraries and rows has many times the pages of
this process, so a fresh engine is many times cheaper from here. ``guard`` runs this file's text: workers need no
copy of the package.
"""

import io
import os
import pickle
import select
import signal
import socket
import sys
import time
import types

#: What a child gets to end by itself once its pipe is closed.
END_SECONDS = 1.0
CODE_BYTES = 8


def answer_of(engine, image):
    """What counts of an engine's answer: its text, the tokens' texts if it gives none, the tokens' scores."""
    text, tokens = engine.read(image)
    tokens = [(t, c) for t, c in tokens]
    return text, None if isinstance(text, str) else [t for t, _ in tokens], [c for _, c in tokens]


def message(problem):
    return str(problem) or type(problem).__name__


def serve(pipe, build, seconds, build_seconds):
    """Answer blocks of pages until the other end is closed; a timer ends the process, whatever it hangs in.

    Each page is answered before the next one is begun, so the other end knows the page that the process ended on.
    """
    signal.signal(signal.SIGALRM, signal.SIG_DFL)
    signal.setitimer(signal.ITIMER_REAL, build_seconds + 5)
    try:
        engine = build()
    except Exception as problem:  # noqa: BLE001
        pipe.sendall(pickle.dumps((False, message(problem))))
        return
    signal.setitimer(signal.ITIMER_REAL, 0)
    pipe.sendall(pickle.dumps((True, None)))
    blocks = pipe.makefile("rb")
    while True:
        try:
            images = pickle.load(blocks)
        except (EOFError, OSError, pickle.UnpicklingError):
            return
        for image in images:
            signal.setitimer(signal.ITIMER_REAL, seconds + 5)
            start = time.monotonic()
            try:
                fine, answer = True, answer_of(engine, bytes(image))
            except Exception as problem:  # noqa: BLE001 - any failure belongs to this page only
                fine, answer = False, message(problem)
            took = time.monotonic() - start
            signal.setitimer(signal.ITIMER_REAL, 0)
            pipe.sendall(pickle.dumps((fine, answer, took)))


def unpickled(data, cloudpickle_source):
    """The object; cloudpickle comes from its source, as importing pyspark for it would treble the process."""
    light = types.ModuleType("light_cloudpickle")
    sys.modules[light.__name__] = light
    exec(compile(cloudpickle_source, "cloudpickle.py", "exec"), light.__dict__)

    class Unpickler(pickle.Unpickler):
        def find_class(self, module, name):
            if module in ("pyspark.cloudpickle", "pyspark.cloudpickle.cloudpickle"):
                return getattr(light, name)
            return super().find_class(module, name)

    return Unpickler(io.BytesIO(data)).load()


def run(control):
    """Fork an engine for each pipe that is sent; ``r`` waits for the last one's end and answers its code."""
    signal.signal(signal.SIGCHLD, signal.SIG_DFL)
    with control.makefile("rb") as kit:
        sys.path[:], build, cloudpickle_source, seconds, build_seconds = pickle.load(kit)
    try:
        signal.setitimer(signal.ITIMER_REAL, build_seconds)
        build = unpickled(build, cloudpickle_source)
        signal.setitimer(signal.ITIMER_REAL, 0)
    except Exception as problem:  # noqa: BLE001
        control.sendall(pickle.dumps((False, f"{type(problem).__name__}: {problem}")))
        return
    control.sendall(pickle.dumps((True, None)))
    child = sentinel = None
    while True:
        order, fds, _, _ = socket.recv_fds(control, 1, 1)
        if not order:
            return
        if order == b"n":
            sentinel, theirs = os.pipe()
            child = os.fork()
            if child == 0:
                code = 1
                try:
                    os.close(sentinel)
                    control.close()
                    serve(socket.socket(fileno=fds[0]), build, seconds, build_seconds)
                    code = 0
                finally:
                    sys.stdout.flush()
                    sys.stderr.flush()
                    os._exit(code)
            os.close(theirs)
            os.close(fds[0])
        else:
            if not select.select([sentinel], [], [], END_SECONDS)[0]:
                os.kill(child, signal.SIGKILL)
            _, status = os.waitpid(child, 0)
            os.close(sentinel)
            control.sendall(f"{os.waitstatus_to_exitcode(status):>{CODE_BYTES}}".encode())


if __name__ == "__main__":
    run(socket.socket(fileno=int(sys.argv[1])))
