"""The datasets: exploration, customer features, churn model, marts, briefs, batch."""
