"""clientele.sources"""
