"""Small inputs with known results."""

# id, features, label
PERCEPTRON = [(0, [3.0, 3.0], 1.0), (1, [4.0, 3.0], 1.0), (2, [1.0, 1.0], -1.0)]

# label, features: the textbook's loan applications
LOANS = [
    (0.0, [1, 2, 2, 3]),
    (0.0, [1, 2, 2, 2]),
    (1.0, [1, 1, 2, 2]),
    (1.0, [1, 1, 1, 3]),
    (0.0, [1, 2, 2, 3]),
    (0.0, [2, 2, 2, 3]),
    (0.0, [2, 2, 2, 2]),
    (1.0, [2, 1, 1, 2]),
    (1.0, [2, 2, 1, 1]),
    (1.0, [2, 2, 1, 1]),
    (1.0, [3, 2, 1, 1]),
    (1.0, [3, 2, 1, 2]),
    (1.0, [3, 1, 2, 2]),
    (1.0, [3, 1, 2, 1]),
    (0.0, [3, 2, 2, 3]),
]

SENTENCES = [
    "Hi I heard about Spark",
    "I wish Java could use case classes",
    "Logistic regression models are neat",
]
