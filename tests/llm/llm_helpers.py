import random


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    """n words drawn from a small vocabulary."""
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
