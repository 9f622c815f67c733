from corpusloom.llm import toxicity


def test_training_looks_at_few_texts_at_a_time(monkeypatch):
    """The words of all training texts at once were many times their size."""
    sizes = []
    whole = toxicity.Model.highest

    def highest(self, texts):
        sizes.append(len(texts))
        return whole(self, texts)

    monkeypatch.setattr(toxicity.Model, "highest", highest)
    texts = [f"vile words {i}" if i % 3 == 0 else f"kind words {i}" for i in range(300)]
    model = toxicity.train(texts, [int(i % 3 == 0) for i in range(300)])
    assert sum(sizes) == 300 and max(sizes) <= toxicity.SCORED
    assert model.score("vile") >= 0.5 > model.score("kind")
