"""Logistic regression by follow-the-regularised-leader updates (McMahan et al. 2013), on sparse rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rates:
    """Learning rate, its offset, and the two penalties."""

    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 0.05
    l2: float = 0.5
    epochs: int = 3


def sigmoid(margin: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, margin))))


class Leader:
    """The state of one model: per coordinate a sum of adjusted gradients and of squared gradients."""

    def __init__(self, dims: int, rates: Rates):
        self.rates = rates
        self.lead = np.zeros(dims)
        self.squares = np.zeros(dims)

    def weights(self, at=slice(None)) -> np.ndarray:
        lead, r = self.lead[at], self.rates
        shrunk = np.sign(lead) * np.maximum(np.abs(lead) - r.l1, 0.0)
        return -shrunk / ((r.beta + np.sqrt(self.squares[at])) / r.alpha + r.l2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        """One row: distinct coordinates ``at`` with their values."""
        w = self.weights(at)
        gradient = (sigmoid(float(w @ value)) - label) * value
        old = self.squares[at]
        new = old + gradient * gradient
        self.lead[at] += gradient - (np.sqrt(new) - np.sqrt(old)) / self.rates.alpha * w
        self.squares[at] = new


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[float], dims: int, rates: Rates) -> np.ndarray:
    """Weights after ``rates.epochs`` passes in an order that the seed fixes."""
    model = Leader(dims, rates)
    order = np.random.default_rng(7)
    for _ in range(rates.epochs):
        for i in order.permutation(len(rows)):
            model.learn(*rows[i], labels[i])
    return model.weights().astype(np.float32)
