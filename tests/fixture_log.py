"""Hand-made interaction log with the edge cases of FIXTURES.md §4."""

from __future__ import annotations

from histwise.sources.inputs import Inputs

TRAIN_SCHEMA = ("row_id long, user_id long, timestamp long, content_id long, content_type_id int, "
                "answered_correctly int, prior_question_elapsed_time double, "
                "prior_question_had_explanation boolean")

SEQ12 = [1, 0, 1, 1, 0, 0, 1, 0, 1, 1, 0, 1]


def rows():
    out = []

    def q(rid, user, ts, item, ac, expl=None):
        out.append((rid, user, ts, item, 0, ac, 1000.0, expl))

    def lecture(rid, user, ts, item):
        out.append((rid, user, ts, item, 1, -1, None, None))

    # user 1: first row, ties on one timestamp, repeats
    q(1, 1, 0, 10, 1, True)
    q(2, 1, 1000, 11, 0)
    q(3, 1, 1000, 12, 1)
    q(4, 1, 1000, 11, 1)
    q(5, 1, 2000, 11, 1)
    q(6, 1, 3000, 10, 0)
    # user 2: a lecture with the same timestamp as a question, larger row_id
    q(20, 2, 0, 10, 1)
    q(21, 2, 500, 11, 1)
    lecture(22, 2, 500, 5)
    # user 3: item answered right by everyone, only that item
    q(30, 3, 0, 50, 1)
    q(31, 3, 1, 50, 1)
    # user 4: item answered wrong by everyone; item whose first attempts are in val
    q(40, 4, 0, 60, 0)
    q(41, 4, 1, 70, 1)
    q(42, 4, 2, 60, 0)
    # user 5: twelve attempts on one item
    for i, ac in enumerate(SEQ12):
        q(50 + i, 5, i, 80, ac)
    # user 6: embeddings (normal, zero, missing)
    q(70, 6, 0, 91, 1)
    q(71, 6, 1, 92, 1)
    q(72, 6, 2, 10, 1)
    q(73, 6, 3, 99, 1)
    q(74, 6, 4, 91, 1)
    # user 7: long history of one item (one part)
    for i in range(102):
        q(1000 + i, 7, i, 200, 1 if i == 0 else 0)
    return out


QUESTIONS = [(10, 1), (11, 2), (12, 2), (50, 3), (60, 3), (70, 3), (80, 5), (91, 6), (92, 6),
             (99, 6), (200, 4)]
LECTURES = [(5, 3, "intention")]
VAL = [41]
EMB = [(91, [1.0] + [0.0] * 9), (92, [1.0, 1.0] + [0.0] * 8), (10, [0.0] * 10)]


def inputs(spark, questions=QUESTIONS) -> Inputs:
    return Inputs(
        train=spark.createDataFrame(rows(), TRAIN_SCHEMA),
        questions=spark.createDataFrame(questions, "question_id long, part int"),
        lectures=spark.createDataFrame(LECTURES, "lecture_id long, part int, type_of string"),
        val_row_id=spark.createDataFrame([(v,) for v in VAL], "row_id long"),
        embeddings=spark.createDataFrame(EMB, "content_id long, vec array<double>"),
    )
